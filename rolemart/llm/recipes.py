"""Exact duplicates by recipes of content-defined chunks.

1. Cut. A text is cut behind the first sentence or line end after ``_LEAST`` characters, and after ``_MOST`` at the latest. Cuts
   depend on the text alone, so equal texts have equal chunks and unequal ones share those that they have in common.
2. Identify. A chunk's identifier is a 64-bit number of its content. The distinct (identifier, chunk) rows show whether two
   contents have one identifier; then all chunks are numbered anew by another rule, until every identifier is verified. Each
   task sends a chunk once, however many copies it holds, and no chunk moves again.
3. Compare. A text's recipe is the ordered list of its identifiers. Texts are equal when their recipes are, so grouping and
   joining move eight bytes for each chunk.

Everything is DataFrame functions. A recipe that very many rows share is pre-aggregated before its shuffle and joined in parts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from rolemart.llm.common import landed, spare, text_of

_LEAST, _MOST = 1024, 8192
_CUT = rf"(?s).{{{_LEAST},{_MOST}}}?[.!?;\n。！？]|.{{1,{_MOST + 1}}}"
_PARTS = 16

Numbering = Callable[[Column], Column]


def _salted(salt: int) -> Numbering:
    return lambda chunk: F.xxhash64(F.sha2(F.concat(F.lit(f"{salt}:".encode()), chunk.cast("binary")), 256))


#: Rules for identifiers, tried in order until no two chunks of the table have one identifier.
NUMBERINGS: tuple[Numbering, ...] = (lambda chunk: F.xxhash64(chunk), *map(_salted, range(1, 8)))


def _readable(text: Column) -> Column:
    """Regular expressions read code points, so bytes that are not UTF-8 are written in another alphabet first."""
    return F.when(F.is_valid_utf8(text), text).otherwise(F.base64(text.cast("binary")))


def chunks(text: Column) -> Column:
    """The chunks of a text in their order; joined they are the text. An empty text has none."""
    return F.regexp_extract_all(text, F.lit(_CUT), F.lit(0))


def _verified(docs: DataFrame, numberings: Sequence[Numbering]) -> Numbering:
    """The first rule that gives different chunks of the table different identifiers."""
    cut = docs.select(F.explode(chunks(_readable(text_of(docs)))).alias("chunk"))
    for number in numberings:
        distinct = cut.select(number(F.col("chunk")).alias("id"), "chunk").distinct()
        if distinct.groupBy("id").count().where("count > 1").isEmpty():
            return number
    raise ValueError("no numbering tells the chunks of this table apart")


def exact_groups(docs: DataFrame, column: str, numberings: Sequence[Numbering] = NUMBERINGS) -> DataFrame:
    """All rows of ``docs`` and all their columns but ``text``, and as ``column`` struct<keep_id,group_size,kept,text_sha256>.

    Rows with identical texts are one group: group_size counts its rows, keep_id is its largest doc_id, and exactly one row is
    kept, one with that doc_id. NULL counts as the empty text, so NULL and empty texts are one group. A NULL doc_id is less
    than any other: keep_id is NULL only where no row of the group has an id. Of several rows with the largest doc_id the one
    with the largest hash of its other columns is kept, and any one of wholly identical rows. Texts of any length pass; an
    empty table stays empty; further columns of any name pass through.
    """
    others = [c for c in docs.columns if c != "text"]
    number = _verified(docs, numberings)
    text = text_of(docs)
    plain = [F.col(f"`{f.name}`") for f in docs.schema if isinstance(f.dataType, AtomicType) and f.name != "text"]
    kept = docs.select(*(F.col(f"`{c}`") for c in others))
    for name in (names := ["exact_row", "exact_tie", "exact_sha", "exact_valid", "exact_recipe", "exact_part"]):
        names[names.index(name)] = spare(kept, name)
    row, tie, sha, valid, recipe, part = names
    recipes = landed(docs.select(
        *(F.col(f"`{c}`") for c in others), F.monotonically_increasing_id().alias(row), F.xxhash64(*plain).alias(tie),
        F.sha2(text.cast("binary"), 256).alias(sha), F.is_valid_utf8(text).alias(valid),
        F.transform(chunks(_readable(text)), number).alias(recipe)), "recipes")
    best = F.max(F.struct(F.col("doc_id").alias("doc_id"), F.col(tie).alias("tie"), F.col(row).alias("row")))
    groups = recipes.groupBy(F.col(valid).alias("g_valid"), F.col(recipe).alias("g_recipe")).agg(best.alias("g_best"), F.count(F.lit(1)).alias("g_size")).where("g_size > 1")
    # a group that many rows have is there once per part, so that its rows spread over tasks
    spread = groups.withColumn("g_part", F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1))))
    taken = [spare(recipes, c) for c in spread.columns]
    g_valid, g_recipe, g_best, g_size, g_part = taken
    same = (F.col(valid) == F.col(g_valid)) & (F.col(recipe) == F.col(g_recipe)) & (F.col(part) == F.col(g_part))
    out = recipes.withColumn(part, F.pmod(F.col(row), F.lit(_PARTS)).cast("int")).join(spread.toDF(*taken), same, "left")
    alone = F.col(g_size).isNull()
    told = F.struct(
        F.when(alone, F.col("doc_id")).otherwise(F.col(f"{g_best}.doc_id")).alias("keep_id"), F.coalesce(g_size, F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col(f"{g_best}.row") == F.col(row))).alias("kept"), F.col(sha).alias("text_sha256"))
    return out.select(*(F.col(f"`{c}`") for c in others if c != column), told.alias(column))
