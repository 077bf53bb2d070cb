"""Removal of lines that many sites share.

A line's spread is the number of distinct sources it occurs in.  (line, source) pairs are
aggregated first, then HyperLogLog sketches per line are merged by aggregation, so a line
that holds a third of all rows costs one small sketch per task.  Where the estimate is near
the limit, the distinct sources of just those lines are counted exactly.  Of a line that
reaches the limit, the first occurrence (smallest doc_id, then place) stays and the others
are removed.

With ``min_words=None`` every line is judged but blank ones, those of separators and control
characters only.  With a number, lines of fewer space-separated parts are never judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerweave.llm.common import body, join_hot, once, text_or_empty
from offerweave.plans.scratch import broadcast_if_small, materialize

MIN_SITES = 5
MIN_WORDS = 4
#: Matches lines that are not blank.
NOT_BLANK = r"[^\p{Z}\p{Cc}]"
LG_K = 12
BROADCAST_ROWS = 500_000
#: Places to remove that may be broadcast together.
BROADCAST_PLACES = 2_000_000
#: What tells rows apart: null ids are ids like others, and texts of one id stay apart.
_ROW = ["noid", "id0", "b1", "b2"]


def _row_key() -> list[Column]:
    return [F.col("doc_id").isNull().alias("noid"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id0"), *body()]


def _line_key(line: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes."""
    return F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2")


def _lines(docs: DataFrame, min_words: int | None) -> DataFrame:
    """``(noid, id0, b1, b2, source, pos, line)`` of every line that is judged."""
    lines = docs.select(
        *_row_key(), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.posexplode(F.split(text_or_empty(), "\n")).alias("pos", "line"),
    )
    if min_words is None:
        return lines.filter(F.col("line").rlike(NOT_BLANK))
    return lines.filter((F.size(F.split("line", " ")) >= min_words) & (F.length(F.trim("line")) > 0))


def spread_lines(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int | None = MIN_WORDS) -> DataFrame:
    """``(h1, h2, sites, exact)`` of the lines that occur in at least ``min_sites`` sources."""
    pairs = materialize(_lines(docs, min_words).groupBy(*_line_key(F.col("line")), "source").agg(F.count("*").alias("c")).select("h1", "h2", "source"), "line-sites")
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("source", LG_K))
    estimates = pairs.groupBy("h1", "h2").agg(sketch.alias("sites"))
    margin = 0.5 + 4 * 1.04 / (2 ** (LG_K / 2)) * min_sites
    possible = materialize(estimates.filter(F.col("sites") > min_sites - 1 - margin), "line-estimates")
    sure = possible.filter(F.col("sites") >= min_sites + margin).withColumn("exact", F.lit(False))
    unsure = possible.filter(F.col("sites") < min_sites + margin).select("h1", "h2")
    # each line and source is one row of pairs
    counted = pairs.join(broadcast_if_small(unsure, BROADCAST_ROWS), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.count("*").alias("sites"))
    return sure.unionByName(counted.filter(F.col("sites") >= min_sites).withColumn("exact", F.lit(True)))


def removed_lines(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int | None = MIN_WORDS) -> DataFrame:
    """``(noid, id0, b1, b2, places)``: the places of the lines to remove from each row that has any."""
    common = materialize(spread_lines(docs, min_sites, min_words).select("h1", "h2"), "spread-lines")
    lines = _lines(docs, min_words).select(*_ROW, "pos", *_line_key(F.col("line")))
    found = materialize(join_hot(lines, common, ["h1", "h2"], ["id0", "b1", "pos"], BROADCAST_ROWS), "occurrences")
    place = ["noid", "id0", "pos", "b1", "b2"]
    first = found.groupBy("h1", "h2").agg(F.min(F.struct(*place)).alias("first")).select("h1", "h2", *[F.col(f"first.{c}").alias(c) for c in place])
    # all of an occurrence is the key, so no task gets all occurrences of a frequent line
    later = found.distinct().join(first, ["h1", "h2", *place], "left_anti")
    return later.groupBy(*_ROW).agg(F.collect_set("pos").alias("places"))


def _cleaned(docs: DataFrame, min_sites: int, min_words: int | None) -> DataFrame:
    """``docs`` with new ``text`` and ``n_chars``, and what was done in ``__offerweave_lines`` and ``__offerweave_removed``."""
    names = {c: f"__offerweave_{c}" for c in [*_ROW, "places"]}
    gone = materialize(removed_lines(docs, min_sites, min_words).withColumnsRenamed(names), "removed-lines")
    places = F.col(names["places"])
    amount = gone.agg(F.coalesce(F.sum(F.size(places) + 8), F.lit(0)).alias("n")).first()["n"]
    gone = F.broadcast(gone) if amount <= BROADCAST_PLACES else gone
    keyed = docs.withColumns({names[c]: x for c, x in zip(_ROW, _row_key(), strict=True)})
    both = keyed.join(gone, [names[c] for c in _ROW], "left")
    n_lines = F.size(F.split(text_or_empty(), "\n"))
    # split keeps a trailing part, so joining what is left is exact
    left = once(F.split("text", "\n"), lambda x: F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), places), lambda i: F.get(x, i)))
    counted = both.withColumn("__offerweave_lines", n_lines).withColumn("__offerweave_removed", F.when(places.isNull(), 0).otherwise(F.size(places)))
    out = counted.withColumn("text", F.when(places.isNull(), F.col("text")).otherwise(F.array_join(left, "\n")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.drop(*names.values())


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int | None = MIN_WORDS) -> DataFrame:
    """``docs`` with new ``text`` and ``n_chars``, and ``n_lines`` and ``n_removed`` at the end.

    Blank lines and lines of fewer than ``min_words`` parts are never removed.  Null text
    stays null and has one line; a null source counts as the empty source.  Of a shared line the
    occurrence with the smallest doc_id stays, null ids last, then that with the smallest place,
    then one of the texts that share all this.  Equal rows lose the same lines; rows with one
    doc_id, or none, and different texts are different documents.  Other columns are kept as
    they are (columns named n_lines or n_removed are replaced).  No rows give no rows.
    """
    new = _cleaned(docs, min_sites, min_words).drop("n_lines", "n_removed")
    return new.withColumnsRenamed({"__offerweave_lines": "n_lines", "__offerweave_removed": "n_removed"})


def without_repeated_lines(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int | None = MIN_WORDS) -> DataFrame:
    """``docs`` without the removed lines; documents of which nothing is left go.

    Nulls, ties, repeated rows and clashing ids as in ``dedup_lines``; null, empty and blank texts
    that lost nothing stay; all columns stay.
    """
    new = _cleaned(docs, min_sites, min_words)
    empty = (F.col("__offerweave_removed") > 0) & (F.length(F.trim(F.coalesce("text", F.lit("")))) == 0)
    return new.filter(~empty).select(*docs.columns)


def digest(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int | None = MIN_WORDS) -> DataFrame:
    """``(doc_id, n_lines, n_removed, kept_chars, kept_md5)`` per document."""
    return dedup_lines(docs, min_sites, min_words).select(
        "doc_id", F.col("n_lines").cast("bigint").alias("n_lines"), F.col("n_removed").cast("bigint").alias("n_removed"),
        F.length(text_or_empty()).cast("bigint").alias("kept_chars"), F.md5(text_or_empty().cast("binary")).alias("kept_md5"),
    )


ORACLE_CTES = r"""
lines as (
  select doc_id, coalesce(source, '') as source, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from docs0
), judged as (
  select * from lines where len(string_split(line, ' ')) >= 4 and length(trim(line)) > 0
), spread as (
  select line from judged group by line having count(distinct source) >= 5
), occ as (
  select j.*, row_number() over (partition by line order by doc_id, pos) as nth from judged j semi join spread using (line)
), dropped as (
  select doc_id, pos from occ where nth > 1
), rebuilt as (
  select l.doc_id, coalesce(string_agg(case when d.pos is null then l.line end, chr(10) order by l.pos), '') as text,
         count(*) as n_lines, count(d.pos) as n_removed
  from lines l left join dropped d on l.doc_id = d.doc_id and l.pos = d.pos group by l.doc_id
)"""

ORACLE = f"""with docs0 as (select * from documents), {ORACLE_CTES}
select doc_id, n_lines, n_removed, length(text)::bigint as kept_chars, md5(text) as kept_md5 from rebuilt"""


#: The same with every non-blank line judged.
ORACLE_ALL = ORACLE.replace("len(string_split(line, ' ')) >= 4 and length(trim(line)) > 0", f"regexp_matches(line, '{NOT_BLANK}')")
