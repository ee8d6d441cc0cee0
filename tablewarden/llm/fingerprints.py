"""Document fingerprints: Merkle trees over sections, paragraphs and their pieces, in SQL functions only.

Sections end at blank lines, paragraphs at line ends, pieces (the leaves) at sentence ends and after
PIECE code points at most. All three keep every code point, so equal roots mean equal texts; unequal ones
are compared branch by branch. A leaf key is the piece's hash and its length, so that two trees tell how much
text they share without the texts.

Nulls: a null text is the empty text, whose tree has no sections. A null doc_id comes last in descending
order. Rows of equal doc_id are ordered by their texts' hashes, then texts; equal rows are interchangeable.
Very long texts: all work is in SQL functions over one row at a time, no piece is longer than PIECE. Empty tables give
empty tables; a single row is its own next document. doc_id is an integer (any type that has quantiles).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Code points in one leaf at most.
PIECE = 300
PARAGRAPHS = r"[^\n]*\n+|[^\n]+"
PIECES = rf"[^.!?]{{1,{PIECE}}}[.!?]*[ \n]*|[.!?]+[ \n]*"
#: Hexadecimal digits of a leaf's hash.
DIGITS = 32
#: Rows that one task orders, and ranges at most: beyond their product ranges grow, and their sorts spill. The plan holds one border a range.
ORDERED, RANGES = 4096, 4096


def sections(text: Column) -> Column:
    """Strings whose concatenation is the text: each runs to the end of a run of blank lines."""
    return F.split(F.regexp_replace(text, r"(\n\n+)", "$1\u0001"), "\u0001")


def leaves(text: Column) -> Column:
    """array<array<array<string>>>: leaf keys by section and paragraph."""
    key = lambda p: F.concat(F.substring(F.sha2(p, 256), 1, DIGITS), F.lit(":"), F.char_length(p).cast("string"))
    paragraph = lambda p: F.transform(F.regexp_extract_all(p, F.lit(PIECES), F.lit(0)), key)
    section = lambda s: F.transform(F.regexp_extract_all(s, F.lit(PARAGRAPHS), F.lit(0)), paragraph)
    return F.transform(sections(text), section)


def branch_hashes(tree: Column) -> Column:
    """One hash a section, over the hashes of its paragraphs, over their leaf keys."""
    paragraph = lambda p: F.sha2(F.array_join(p, ","), 256)
    return F.transform(tree, lambda s: F.sha2(F.array_join(F.transform(s, paragraph), ","), 256))


def root(tree: Column) -> Column:
    return F.sha2(F.array_join(branch_hashes(tree), ","), 256)


def leaf_set(tree: Column) -> Column:
    return F.array_distinct(F.flatten(F.flatten(tree)))


def weight(keys: Column) -> Column:
    """Code points under distinct leaf keys."""
    return F.aggregate(keys, F.lit(0).cast("long"), lambda a, k: a + F.substring(k, DIGITS + 2, 12).cast("long"))


def likeness(a: Column, b: Column) -> Column:
    """Share of the code points of two leaf sets that stand under common leaves: 0 to 1, 1 for two empty ones."""
    both = weight(a) + weight(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(F.round(weight(F.array_intersect(a, b)) * 2.0 / both, 6))


def changed_branches(a: Column, b: Column) -> Column:
    """Indexes of the sections (of either tree) whose hashes differ: where edits lie."""
    n = F.greatest(F.size(a), F.size(b))
    return F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: (i < n) & ~F.get(a, i).eqNullSafe(F.get(b, i)))


def with_next(df: DataFrame, key: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """df with `name`: the value of the next row in descending key (ties by order); the last row gets the first row's.

    Ranges of the key are ordered on their own. The range borders are values of the key (quantiles of it, one
    in ORDERED rows, RANGES at most, so the plan does not grow with the table); rows at a border are also sent to the range below, where they stand last and are dropped.
    """
    n = df.count()
    parts = min(RANGES, max(1, math.ceil(n / ORDERED)))
    marks = df.agg(F.percentile_approx(key, [i / parts for i in range(1, parts + 1)], max(10_000, 4 * parts)).alias("m")).first()["m"] if n else None
    marks = sorted(set(marks or []))
    if not marks:  # no key at all: one order by the ties
        marks = [0]
    # range r holds keys over marks[r - 1] up to marks[r]; found by two short scans, of every step-th mark and of the marks between
    step = max(1, math.isqrt(len(marks)))
    coarse = F.array(*[F.lit(m) for m in marks[step - 1 :: step]])
    below = F.size(F.filter(coarse, lambda m: m < F.col(key))) * step
    fine = F.array(*[F.lit(m) for m in marks])
    part = F.when(F.col(key).isNull(), F.lit(0)).otherwise(below + F.size(F.filter(F.slice(fine, below + 1, F.lit(step)), lambda m: m < F.col(key))))
    last = len(marks) - 1
    rows = df.withColumn("_part", part.cast("int"))
    # the largest key of a range is the first row of its order, and the next row of the last row in the range above
    ghost = F.when(F.get(fine, F.col("_part")).eqNullSafe(F.col(key)), F.when(F.col("_part") == last, F.lit(0)).otherwise(F.col("_part") + 1))
    if last == 0 and marks == [0]:
        ghost = F.lit(0)
    both = rows.withColumn("_at", F.explode(F.when(ghost.isNull(), F.array(F.struct(F.col("_part").alias("part"), F.lit(0).alias("ghost")))).otherwise(F.array(F.struct(F.col("_part").alias("part"), F.lit(0).alias("ghost")), F.struct(ghost.cast("int").alias("part"), F.lit(1).alias("ghost"))))))
    both = both.select(*df.columns, F.col("_at.part").alias("_part"), F.col("_at.ghost").alias("_ghost"))
    over = Window.partitionBy("_part").orderBy("_ghost", F.col(key).desc_nulls_last(), *order)
    return both.withColumn(name, F.lead(value).over(over)).filter("_ghost = 0").drop("_part", "_ghost")


def edited_by_next(df: DataFrame) -> DataFrame:
    """doc_id, text, next_text, edited: the last third of every text replaced by the start of the next document's, in descending doc_id."""
    ties = [F.sha2("text", 256), F.col("text")]
    out = with_next(df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", ties, F.col("text"), "next_text")
    third = F.floor(F.char_length("text") / 3).cast("int")
    return out.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.char_length("text") - third), F.substring("next_text", F.lit(1), third)))


def compare_edits(df: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses to each other and to the next document's."""
    rows = edited_by_next(df)
    rows = rows.select("*", leaves(F.col("text")).alias("tree"), leaves(F.col("edited")).alias("edited_tree"), leaf_set(leaves(F.col("next_text"))).alias("next_set"))
    rows = rows.select("*", branch_hashes(F.col("tree")).alias("branches"), branch_hashes(F.col("edited_tree")).alias("edited_branches"), leaf_set(F.col("tree")).alias("own_set"), leaf_set(F.col("edited_tree")).alias("edited_set"))
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.sha2(F.array_join("branches", ","), 256).alias("fingerprint"),
        F.sha2(F.array_join("edited_branches", ","), 256).alias("edited_fingerprint"),
        likeness(F.col("own_set"), F.col("edited_set")).alias("near_edited"),
        likeness(F.col("own_set"), F.col("next_set")).alias("near_next"),
        F.size("own_set").cast("long").alias("n_leaves"),
        F.size(changed_branches(F.col("branches"), F.col("edited_branches"))).cast("long").alias("changed_sections"),
    )
