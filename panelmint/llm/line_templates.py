"""Repeated lines by a log-template tree, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmint.llm.common import land, parted, sieved, unused

#: What parts tokens besides the space; a line holds no line feed.
BLANKS = "\t\x0b\x0c\r"
#: A whole token with a digit in it, in a line parted by spaces alone. Possessive, from the token's start: each character is read once.
FIELD = "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"
VARIABLE = "<*>"

def _size(flat: Column) -> Column:
    spaces = F.octet_length(flat) - F.octet_length(F.replace(flat, F.lit(" "), F.lit("")))
    return F.when(flat == "", 0).otherwise(spaces + 1)


def _words(flat: Column, size: Column) -> Column:
    listed = F.size(F.array_remove(F.split(flat, " ", -1), VARIABLE))
    return F.when(F.contains(flat, F.lit(VARIABLE)), listed).otherwise(size)


#: From a line to `flat`, its tokens with one space between and those with a digit as variable fields; `size`, the number of tokens; and
#: `words`, of those that are no variable fields.
STEPS = (
    lambda line: F.when(line.rlike(f"[{BLANKS}]"), F.translate(line, BLANKS, " " * len(BLANKS))).otherwise(line),
    lambda line: F.when(line.rlike("[0-9]"), F.regexp_replace(line, FIELD, VARIABLE)).otherwise(line),
    lambda line: F.trim(F.when(F.contains(line, F.lit("  ")), F.regexp_replace(line, " {2,}", " ")).otherwise(line)),
    lambda flat: F.struct(flat.alias("flat"), _size(flat).alias("size")),
    lambda line: F.struct(line["flat"].alias("flat"), line["size"].alias("size"), _words(line["flat"], line["size"]).alias("words")),
)


def _lines(docs: DataFrame) -> DataFrame:
    """(row, doc_id, pos, flat, size, words) of every line. They are made inside the generator, step by step: Spark would
    make them again wherever they are used twice, in filters above all. No line becomes an array here."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("row", "doc_id", F.posexplode(reduce(F.transform, STEPS, F.split("text", "\n", -1))).alias("pos", "line"))
    return rows.select("row", "doc_id", "pos", "line.flat", "line.size", "line.words")


def _leaf(lead: int) -> Column:
    """Place in the tree: token count at the first level, leading tokens below. Also the digest that lines meet by."""
    return F.xxhash64("size", F.substring_index("flat", " ", lead))


def _templates(lines: DataFrame, placed: DataFrame, min_docs: int, constant: float, least: int) -> DataFrame:
    """(line, template) of the lines whose constant tokens may recur: a leaf holds as many templates as its lines make."""
    # Leaves that several documents reach. Rows are (leaf, document) before they meet by leaf, so a hot leaf is counted in parts.
    busy = placed.where(F.col("words") > least).select("leaf", "row").distinct()
    busy = land(busy.groupBy("leaf").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs).select("leaf"), "leaves")

    # Distinct lines of these leaves with the number of lines each stands for.
    # Most lines of prose are alone in their leaf: they are sieved out where they lie.
    full = sieved(lines.where(F.col("words") > least).select("leaf", "words", "flat"), busy, "leaf")
    kinds = land(full.groupBy("leaf", "words", "flat").agg(F.count(F.lit(1)).alias("n")), "kinds")
    need = F.greatest(F.lit(least), F.ceil(F.lit(constant) * F.col("words")).cast("int"))
    # In a step of its own: beside the generator, a line's digest would be made once for each of its tokens.
    kinds = kinds.select(F.xxhash64("flat").alias("line"), "n", need.alias("need"), "leaf", "flat")
    cells = kinds.select("line", "n", "need", "leaf", F.posexplode(F.split("flat", " ", -1)).alias("at", "token"))
    cells = cells.where(F.col("token") != VARIABLE).select("line", "n", "need", "at", F.xxhash64("leaf", "at", "token").alias("pair"))
    # A template of several documents has no token that fewer lines have at its place.
    seen = land(cells.groupBy("pair").agg(F.sum("n").alias("seen")).where(F.col("seen") >= min_docs), "pairs")
    met = sieved(cells.drop("n"), seen, "pair", unique=True)
    order = F.array_sort(F.collect_list(F.struct((-F.col("seen")).alias("less"), "at", "pair")))  # at most the tokens of one line
    lined = met.groupBy("line", "need").agg(order.alias("pairs")).where(F.size("pairs") >= F.col("need"))
    return lined.select("line", F.xxhash64(F.transform(F.slice("pairs", F.lit(1), F.col("need")), lambda p: p["pair"])).alias("template"))


def _later(known: DataFrame, key: str, docs: Column, *also: str) -> DataFrame:
    """(row, pos) of lines whose `key` occurs in `docs` documents or more, but for those of its first document. `docs` may use the
    columns `also`, which follow from the key."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    spread = known.select(key, *also, "doc_id", "row").distinct().groupBy(key, *also).agg(F.count(F.lit(1)).alias("docs"), F.min(order).alias("first"))
    spread = land(spread.where(F.col("docs") >= docs).select(key, F.col("first.row").alias("first")), "spread")
    return sieved(known.select("row", "pos", key), spread, key, unique=True).where("row <> first").select("row", "pos")


def recurring_lines(docs: DataFrame, lead: int = 2, min_tokens: int = 4, min_docs: int = 3, constant: float = 0.75, least: int = 5, passage: int = 20) -> DataFrame:
    """(row, pos) of the lines to drop, some of them twice. See drop_lines()."""
    lines = _lines(docs).where(F.col("size") >= min_tokens).withColumn("leaf", _leaf(lead))
    placed = land(lines.select("row", "doc_id", "pos", "leaf", "words", F.xxhash64("flat").alias("line")), "lines")
    equal = _later(placed, "line", F.when(F.col("words") >= passage, 2).otherwise(min_docs), "words")
    templates = land(_templates(lines, placed, min_docs, constant, least), "templates")
    known = land(sieved(placed.drop("leaf"), templates, "line", unique=True), "known")
    return equal.unionByName(_later(known, "template", F.lit(min_docs)))


def drop_lines(docs: DataFrame, **options) -> DataFrame:
    """`docs` without lines whose template recurs in `min_docs` documents or more: all columns, text replaced, and n_lines, n_dropped.

    A line goes to a leaf of a tree of fixed depth: first its number of tokens, then its `lead` leading tokens; tokens with a
    digit count as variable from the start, the others are words. A token's frequency is the number of lines of the leaf that have it at its place. The
    template of a line with more than `least` words are its most frequent words, `constant` of them (rounded up, `least` or more; of equal
    ones the first); its other tokens are variable fields. So a leaf has as many templates as it needs, and lines that join a
    leaf change a line's template only by the order of its own words. Lines are dropped where their template occurs in
    `min_docs` documents or more; lines that are equal but for tokens with a digit also, from two documents on if they have `passage` words. The
    document with the smallest doc_id that has the template or line keeps it (documents without one come last). Lines below
    `min_tokens` tokens and empty lines always stay.

    Null text is empty: one empty line. A line that repeats inside one document is no recurrence. Rows that repeat a doc_id are separate
    documents. `docs` must be read from a table, so that row numbers hold; columns named n_lines or n_dropped are replaced.
    """
    drops = recurring_lines(docs, **options)
    row, lost = unused(docs, "__row", "__gone")
    gone = land(drops.groupBy(F.col("row").alias(row)).agg(F.collect_set("pos").alias(lost)), "gone")  # at most the lines of one text
    # Documents that lose nothing are not shuffled.
    some, others = parted(docs.withColumn(row, F.monotonically_increasing_id()), gone, row)
    met = some.join(gone, row, "left").unionByName(others.withColumn(lost, F.lit(None).cast("array<int>")))
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    gone_map = F.map_from_arrays(lost, F.transform(lost, lambda p: F.lit(True)))
    kept = F.filter(lines, lambda _, k: ~F.coalesce(F.element_at(gone_map, k), F.lit(False)))
    return (
        met.withColumn("n_lines", F.size(lines))
        .withColumn("n_dropped", F.coalesce(F.size(lost), F.lit(0)))
        .withColumn("text", F.when(F.col(lost).isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n")))
        .drop(row, lost)
    )
