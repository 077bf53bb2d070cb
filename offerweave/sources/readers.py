"""Sources and sinks: store files, category maps, sitemaps, exports, state tables."""

from __future__ import annotations

import gzip
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerweave.plans.scratch import materialize
from offerweave.sources.schema import STAGING, blank


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def store_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of JSON array files with their ``ordinal`` in the file; missing files are skipped.

    The array is read whole, so its order is known and does not depend on how files are split.
    """
    there = [p for p in paths if exists(spark, p)]
    if not there:
        return spark.createDataFrame([], STAGING).withColumn("ordinal", F.lit(0).cast("int"))
    raw = spark.read.text(there, wholetext=True)
    kind = "array<" + STAGING.simpleString() + ">"
    rows = raw.select(F.posexplode(F.from_json("value", kind)).alias("ordinal", "row"))
    return rows.select("row.*", "ordinal").withColumn("price", F.col("price").cast("decimal(18,4)"))


def category_map(df: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """Trimmed (store, raw_product_type, category) of CSV rows; blank categories go, unknown ones fail.

    ``df`` needs store, raw_product_type, canonical_category and ``ordinal``; the last duplicate wins.
    """
    rows = df.select(F.trim("store").alias("store"), F.trim("raw_product_type").alias("raw_product_type"), F.trim("canonical_category").alias("category"), "ordinal")
    rows = rows.filter(~blank(F.col("category")))
    bad = F.raise_error(F.concat(F.lit("unknown category: "), F.col("category"))).cast("string")
    rows = rows.withColumn("category", F.when(F.col("category").isin(*allowed), F.col("category")).otherwise(bad))
    return rows.groupBy("store", "raw_product_type").agg(F.max_by("category", "ordinal").alias("category"))


def read_category_csv(spark: SparkSession, path: str) -> DataFrame:
    schema = "store string, raw_product_type string, product_count string, canonical_category string"
    rows = spark.read.schema(schema).option("header", True).csv(path)
    return rows.withColumn("ordinal", F.monotonically_increasing_id())


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def update_csv(spark: SparkSession, path: str, header: list[str], change: Callable[[DataFrame], DataFrame]) -> None:
    """Replace a CSV by ``change`` of it; what was there first stays as ``path.bak``.

    The header must be exactly ``header`` before and after.  The new rows are written beside the
    old ones and then take their name, so a job that fails leaves the old file.
    """
    held = spark.read.option("header", True).csv(path)
    if held.columns != header:
        raise ValueError(f"CSV header is {held.columns}, expected {header}")
    new = change(held)
    if new.columns != header:
        raise ValueError(f"new CSV header is {new.columns}, expected {header}")
    write_csv(new, f"{path}.new")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(at(f"{path}.bak")):
        fs.delete(at(path), True)
    elif not fs.rename(at(path), at(f"{path}.bak")):
        raise OSError(f"cannot keep {path} as {path}.bak")
    if not fs.rename(at(f"{path}.new"), at(path)):
        raise OSError(f"cannot move {path}.new to {path}")


def side_sink(held: DataFrame, rows: DataFrame, key: list[str], order: str = "ordinal") -> DataFrame:
    """``held`` after an upsert of ``rows``: the last row of each key replaces what was held."""
    return merge_retry(held, last_per_key(rows, key, order).select(*held.columns), key)


def copy_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Tab-separated lines with ``\\N`` for null, t/f for booleans and escaped backslash, tab and line ends."""

    def field(name: str) -> Column:
        if dict(df.dtypes)[name] == "boolean":
            return F.when(F.coalesce(F.col(name), F.lit(False)), "t").otherwise("f")
        text = F.col(name).cast("string")
        for old, new in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            text = F.replace(text, F.lit(old), F.lit(new))
        return F.coalesce(text, F.lit("\\N"))

    return df.select(F.concat_ws("\t", *[field(c) for c in columns]).alias("line"))


def _locs(kind: str) -> Column:
    """The ``loc`` right below the elements of one kind; those of images or of other kinds are left out."""
    return F.expr(f"xpath(body, \"//*[local-name()='{kind}']/*[local-name()='loc' and namespace-uri()=namespace-uri(..)]/text()\")")


def sub_sitemaps(files: DataFrame, index: str, name: str = "") -> DataFrame:
    """``(ordinal, body)`` of the sitemaps of files(path, body) that the index at ``index`` lists, in its order.

    Only addresses that contain ``name`` are followed; one that is not among the files is an error.
    """
    listed = files.filter(F.col("path") == index).select(F.posexplode(_locs("sitemap")).alias("ordinal", "sub")).withColumn("sub", F.trim("sub"))
    listed = listed.filter(F.col("sub").contains(name)).groupBy("sub").agg(F.min("ordinal").alias("ordinal"))
    found = listed.join(files, F.col("sub") == F.col("path"), "left")
    missing = F.raise_error(F.concat(F.lit("no such sitemap: "), F.col("sub"))).cast("string")
    return found.select("ordinal", F.coalesce("body", missing).alias("body"))


def sitemap_urls(bodies: DataFrame, pattern: str = "") -> DataFrame:
    """Distinct page addresses of sitemap bodies(ordinal, body) in which ``pattern`` is found, in order of first appearance."""
    each = bodies.select("ordinal", F.posexplode(_locs("url")).alias("pos", "url")).withColumn("url", F.trim("url"))
    each = each.filter(F.col("url").rlike(pattern)) if pattern else each
    return each.groupBy("url").agg(F.min(F.struct("ordinal", "pos")).alias("at")).select("url", "at.ordinal", "at.pos")


def maybe_gzip(files: DataFrame) -> DataFrame:
    """``(path, body)`` of binary files that may or may not be gzip, whatever their names say."""

    def run(batches):
        for batch in batches:
            bodies = []
            for content in batch.column("content").to_pylist():
                try:
                    content = gzip.decompress(content) if content else b""
                except (OSError, EOFError):
                    pass
                bodies.append(content.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(bodies, pa.string())], names=["path", "body"])

    return files.select("path", "content").mapInArrow(run, "path string, body string")


def pages_until_empty(pages: DataFrame, listing: list[str] | None = None, max_pages: int | None = None) -> DataFrame:
    """Items of pages(page, items) up to the first page without items; the first copy of an id counts.

    Every ``listing`` (columns of ``pages``) stops by itself, and an id counts once in each.
    Where ``pages`` has a column ``complete``, a page whose flag says "true" (text or boolean,
    null as well) is the last; where it has ``total``, so is the page with which that many
    items were read (null is 0); so is page number ``max_pages`` in order.
    """
    key = list(listing or [])
    n = F.greatest(F.coalesce(F.size("items"), F.lit(0)), F.lit(0))
    extra = [c for c in ("complete", "total") if c in pages.columns]
    ended, order = F.col("n") == 0, Window.partitionBy(*key).orderBy("page")
    if "complete" in extra:
        ended = ended | (F.lower(F.coalesce(F.col("complete").cast("string"), F.lit("true"))) == "true")
    marks = pages.select(*key, "page", n.alias("n"), *extra)
    if "total" in extra:
        marks = marks.withColumn("got", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        ended = ended | (F.col("got") >= F.coalesce("total", F.lit(0)))
    if max_pages is not None:
        marks = marks.withColumn("nth", F.row_number().over(order))
        ended = ended | (F.col("nth") >= max_pages)
    stops = marks.filter(ended).groupBy(*[F.col(c).alias(f"__stop_{c}") for c in key]).agg(F.min("page").alias("__stop"))
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"__stop_{c}"))
    read = pages.join(stops if key else F.broadcast(stops), same, "left").filter(F.col("__stop").isNull() | (F.col("page") <= F.col("__stop")))
    rows = read.select(*key, "page", F.posexplode("items").alias("pos", "item"))
    return rows.groupBy(*key, "item.id").agg(F.min_by("item", F.struct("page", "pos")).alias("item"))


def leaf_categories(nodes: DataFrame, depth: int | None = None) -> DataFrame:
    """Leaves below the roots of nodes(id, parent, level): they have an id, level other than "0" and no children.

    All levels are walked.  A cycle below a root is an error, and so is a tree of more than
    ``depth`` levels below the roots where that is given.
    """
    reached = frontier = materialize(nodes.filter("parent is null").select("id", "level").distinct(), "tree-level")
    walked, again = 0, False
    while True:
        step = nodes.join(frontier.select(F.col("id").alias("parent")).distinct(), "parent").select("id", "level").distinct()
        step = materialize(step, "tree-level")
        if step.isEmpty():
            break
        walked += 1
        if depth is not None and walked > depth:
            raise ValueError(f"more than {depth} levels of categories")
        again = again or not step.intersect(reached).isEmpty()
        frontier = materialize(step.subtract(reached), "tree-level")
        reached = reached.unionByName(frontier)
    if again:
        _require_no_cycle(nodes, reached)
    parents = nodes.filter("parent is not null").select(F.col("parent").alias("id")).distinct()
    return reached.filter("id is not null and level <> '0'").join(parents, "id", "left_anti").distinct()


def _require_no_cycle(nodes: DataFrame, reached: DataFrame) -> None:
    """Take away nodes without children until none are left; what cannot be taken away is a cycle."""
    edges = nodes.select("parent", "id").join(reached.select(F.col("id").alias("parent")).distinct(), "parent", "left_semi").distinct()
    edges = materialize(edges, "tree-edges")
    left = edges.count()
    while left:
        edges = materialize(edges.join(edges.select(F.col("parent").alias("id")).distinct(), "id", "left_semi"), "tree-edges")
        before, left = left, edges.count()
        if before == left:
            raise ValueError("a category is below itself")


def merge_retry(rows: DataFrame, recovered: DataFrame, key: list[str]) -> DataFrame:
    """Recovered rows replace those of their key, new ones are added."""
    return rows.join(recovered.select(*key).distinct(), key, "left_anti").unionByName(recovered)


def failed_keys(requested: DataFrame, parsed: DataFrame, key: list[str]) -> DataFrame:
    return requested.join(parsed.select(*key).distinct(), key, "left_anti")


def last_per_key(rows: DataFrame, key: list[str], order: str = "ordinal") -> DataFrame:
    """The last row of each key, by its ordinal."""
    return _pick(rows, key, order, F.max_by)


def first_per_key(rows: DataFrame, key: list[str], order: str = "ordinal") -> DataFrame:
    return _pick(rows, key, order, F.min_by)


def _pick(rows: DataFrame, key: list[str], order: str, by) -> DataFrame:
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(by(F.struct(*rest), order).alias("r")).select(*key, "r.*")
