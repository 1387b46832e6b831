from pyspark.sql import functions as F

from panelmint.llm import chat, exact_dedup, line_templates, mixing

INNER = ("__source", "__parts", "__cdf", "__n", "__order", "__row", "__gone", "row")


def test_columns_with_inner_names_survive(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    rows = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("one two three four five").alias("text"), F.lit("s").alias("source"))
    rows.withColumns({name: F.concat(F.lit(name), F.col("doc_id")) for name in INNER}).write.parquet(path)
    docs = spark.read.parquet(path)
    for made in (mixing.poisson_mix(docs), exact_dedup.drop_exact(docs), line_templates.drop_lines(docs)):
        assert set(docs.columns) <= set(made.columns)
        found = made.collect()
        assert found and all(r[name] == f"{name}{r.doc_id}" for r in found for name in INNER)


def test_no_control_string_is_spelled_across_parts(spark):
    part = lambda text, kind="text": (kind, text, None, None, None, None, None)
    turns = [
        (1, 0, "user", [part("<|"), part("end|>")]),
        (1, 1, "assistant", [part("<"), part("\\|end|>"), part("x", "image"), part("<|"), part(None), part("turn|>")]),
        (2, 0, "assistant", [part("<", None), part("/s>", "unknown")]),
    ]
    schema = "conv_id long, turn long, role string, parts array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
    template = chat.Template()
    placed = chat.place_turns(chat.format_turns(spark.createDataFrame(turns, schema)))
    contents = []
    for r in placed.collect():
        content = r.formatted[r.content_start : r.content_start + r.content_chars]
        assert all(mark not in content.replace("<|image|>", "") for mark in (*template.MARKS, *template.reserved))
        contents.append(template.unescape(content))
    assert sorted(contents) == sorted(["<|end|>", "<\\|end|><|image|><|turn|>", "</s>"])
    read = {r.conv_id: r for r in chat.read_back(placed).collect()}
    assert read[1].loss_chars == len("<\\|end|><|image|><|turn|>") and read[2].n_turns == 1
