"""Registered queries of the operators, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from panelmint.llm import chat, collocations, context_mixing, exact_dedup, language_id, line_templates, mixing, near_dedup, nn_descent, packing, prefix_trie, quality, secrets
from panelmint.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-1, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))], given.schema
    )
    segments = chat.format_turns(given.unionByName(probe))
    return chat.read_back(chat.place_turns(segments))


@query
def op2_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.poisson_mix(table(spark, folder, "documents"))


ORACLES["op2_poisson_mix"] = """
WITH RECURSIVE c AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, 0.5) AS share FROM documents GROUP BY source),
r AS (SELECT source, share / (SELECT sum(share) FROM c) * (SELECT sum(n)::DOUBLE FROM c) / n AS rate FROM c),
s AS (SELECT source, greatest(1, ceil(rate / 16.0)::INT) AS parts, rate / greatest(1, ceil(rate / 16.0)::INT) AS mean FROM r),
p(source, parts, mean, k, p, cdf) AS (
  SELECT source, parts, mean, 0, exp(-mean), exp(-mean) FROM s
  UNION ALL SELECT source, parts, mean, k + 1, p * mean / (k + 1), cdf + p * mean / (k + 1) FROM p WHERE k < 96),
steps AS (SELECT source, any_value(parts) AS parts, list(cdf ORDER BY k) AS cdf FROM p GROUP BY source),
draws AS (SELECT d.*, steps.cdf, unnest(range(1, steps.parts + 1)) AS part FROM documents d JOIN steps ON d.source IS NOT DISTINCT FROM steps.source),
counted AS (SELECT doc_id, sum(len(list_filter(cdf, lambda x: x < (('0x' || substr(md5('0:' || doc_id || ':' || part), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0))) AS n
  FROM draws GROUP BY doc_id)
SELECT d.*, unnest(range(0, n::BIGINT))::INT AS copy FROM documents d JOIN counted USING (doc_id)
"""


@query
def op3_bestfit_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


@query
def op4_setsketch_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, folder, "documents"))


@query
def op5_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return context_mixing.score_documents(table(spark, folder, "documents"))


@query
def op6_block_naming(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents")).drop("row")


ORACLES["op6_block_naming"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
"""


@query
def op7_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    clean = line_templates.drop_lines(table(spark, folder, "documents"))
    return clean.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


ORACLES["op7_line_templates"] = r"""
WITH l AS (SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
u AS (SELECT doc_id, row, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM l),
t AS (SELECT *, list_filter(string_split_regex(regexp_replace(line, '[^ 	-
]*[0-9][^ 	-
]*', '<*>', 'g'), '[ 	-
]+'), lambda x: x <> '') AS tokens FROM u),
p AS (SELECT *, tokens[1:2] AS head, len(tokens) AS size, len(list_filter(tokens, lambda x: x <> '<*>')) AS words FROM t WHERE len(tokens) >= 4),
kinds AS (SELECT size, head, words, tokens, count(*) AS n FROM p WHERE words > 5 GROUP BY ALL),
cells AS (SELECT size, head, words, tokens, n, unnest(range(1, size + 1)) AS place, unnest(tokens) AS token FROM kinds),
seen AS (SELECT size, head, place, token, sum(n) AS seen FROM cells WHERE token <> '<*>' GROUP BY ALL),
ranked AS (SELECT c.size, c.head, c.words, c.tokens, c.place, c.token,
  row_number() OVER (PARTITION BY c.size, c.head, c.tokens ORDER BY s.seen DESC, c.place) AS rank
  FROM cells c JOIN seen s ON c.size = s.size AND c.head = s.head AND c.place = s.place AND c.token = s.token),
templates AS (SELECT size, head, tokens, list((place, token) ORDER BY place) AS template FROM ranked
  WHERE rank <= greatest(5, ceil(0.75 * words)) GROUP BY ALL),
known AS (SELECT p.doc_id, p.row, p.pos, size, head, template FROM p JOIN templates USING (size, head, tokens)),
spread AS (SELECT size, head, template, min(doc_id) AS first_doc FROM known GROUP BY ALL HAVING count(DISTINCT row) >= 3),
equals AS (SELECT tokens, min(doc_id) AS first_doc FROM p GROUP BY tokens, words HAVING count(DISTINCT row) >= CASE WHEN words >= 20 THEN 2 ELSE 3 END),
gone AS (SELECT row, pos FROM known JOIN spread USING (size, head, template) WHERE doc_id <> first_doc
  UNION SELECT row, pos FROM p JOIN equals USING (tokens) WHERE doc_id <> first_doc),
lists AS (SELECT row, list(pos) AS gone FROM gone GROUP BY row)
SELECT doc_id, len(lines)::INT AS n_lines, coalesce(len(gone), 0)::INT AS n_dropped,
  sha256(array_to_string(list_filter(lines, lambda x, i: NOT list_contains(coalesce(gone, []), i - 1)), chr(10))) AS text_sha256
FROM l LEFT JOIN lists USING (row)
"""


@query
def op8_nn_descent(spark: SparkSession, folder: str) -> DataFrame:
    return nn_descent.near_vectors(table(spark, folder, "embeddings"))


@query
def op9_secret_grammar(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(table(spark, folder, "documents"))


def fold(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string")) % 5


@query
def op10_quality_mil(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.learn_quality(docs, labels.where(fold() != 0))
    scored = quality.score_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (fold() == 0).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op11_phrase_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


ORACLES["op11_phrase_tiles"] = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
t AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
total AS (SELECT lang, sum(len(ws)) AS n FROM t GROUP BY lang),
g AS (SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4], lambda k: list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])))) AS w FROM t),
f AS (SELECT lang, w, count(*) AS f FROM g GROUP BY lang, w HAVING count(*) >= 30),
c AS (SELECT lang, w, f AS a, unnest(range(1, len(w))) AS k FROM f WHERE len(w) >= 2),
s AS (SELECT c.*, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.w = c.w[1:k] JOIN f y ON y.lang = c.lang AND y.w = c.w[k + 1:]),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
inner_ AS (SELECT lang, f, unnest(flatten(list_transform(range(2, len(w)), lambda k: list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])))) AS w FROM f WHERE len(w) >= 3),
most AS (SELECT lang, w, max(f) AS f FROM inner_ GROUP BY lang, w),
kept AS (SELECT best.*, array_to_string(best.w, ' ') AS phrase FROM best LEFT JOIN most USING (lang, w) WHERE most.f IS NULL OR 100::HUGEINT * most.f < 80::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query
def op12_byte_gru(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_id.learn_language(docs.where(~held_out).select("text", "lang"))
    scored = language_id.predict_language(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_tree(table(spark, folder, "conversations"))


ORACLES["op13_prefix_trie"] = r"""
WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, c - c % 20 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda s, b: list_reduce(list_prepend(xor(s, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 AS h FROM ids),
o AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
size AS (SELECT c AS base, count(*) AS size FROM o GROUP BY c),
r AS (SELECT h.c, pos, role, text FROM h JOIN o ON o.c = h.base AND pos <= h
  UNION ALL SELECT h.c, pos - h + least(h, coalesce(size, 0)), role, text FROM h JOIN o ON o.c = h.c LEFT JOIN size USING (base) WHERE pos > h),
m AS (SELECT c, pos AS d, text, string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY c ORDER BY pos) AS k FROM r
  UNION ALL SELECT c, 0, '', '' FROM ids),
p AS (SELECT *, lag(k) OVER w AS pk, row_number() OVER (PARTITION BY c ORDER BY d DESC) = 1 AS is_end FROM m WINDOW w AS (PARTITION BY c ORDER BY d)),
n AS (SELECT k, d, any_value(pk) AS pk, min(c) AS conv_id, count(*) AS n_convs, any_value(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) AS words,
  coalesce(sha256(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_end)), sha256('')) AS ends_sha256 FROM p GROUP BY k, d),
kids AS (SELECT pk AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY pk),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (k)),
s AS (SELECT m.k, m.d, sum((n_convs - 1) * words) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM f JOIN m ON m.c = f.conv_id AND m.d <= f.d GROUP BY m.k, m.d)
SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN s USING (k, d) LEFT JOIN n q ON q.k = f.pk AND q.d = f.d - 1
"""


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
