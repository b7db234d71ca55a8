"""Readers and writers with fixed schemas."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ledgerlark import schemas
from ledgerlark.functions.text import parse_date
from ledgerlark.session import shuffles_dropped, stage


@dataclass
class Source:
    """Where a table lies and the step that makes it."""

    path: str
    schema: StructType
    made_by: str
    format: str = "parquet"
    optional: bool = False


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def require(spark: SparkSession, sources: dict[str, Source]) -> None:
    """Fail before any job if inputs are missing, naming all of them and the steps that make them."""
    missing = {n: s for n, s in sources.items() if not s.optional and not path_exists(spark, s.path)}
    if missing:
        names = ", ".join(f"{n} ({s.path})" for n, s in missing.items())
        steps = ", ".join(dict.fromkeys(s.made_by for s in missing.values()))
        raise FileNotFoundError(f"missing input: {names}. Run first: {steps}")


def load(spark: SparkSession, sources: dict[str, Source]) -> dict[str, DataFrame | None]:
    """All sources by name; an optional one that is absent is None."""
    require(spark, sources)

    def read(s: Source) -> DataFrame | None:
        if not path_exists(spark, s.path):
            return None
        return {"csv": read_csv, "json": read_json}.get(s.format, read_parquet)(spark, s.path, s.schema)

    return {name: read(s) for name, s in sources.items()}


def read_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_csv_parsing_dates(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV whose bad dates become null rather than failing the read or the row."""
    days = [f.name for f in schema if isinstance(f.dataType, DateType)]
    raw = read_csv(spark, path, schemas.as_text(schema, *days))
    return raw.withColumns({d: parse_date(F.col(d)) for d in days}).select(*schema.names)


REJECTED = "_rejected"


def read_csv_with_rejects(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, rejected lines as text in `line`).

    A line is rejected if it has fewer or more fields than the schema, or a field that is not of its
    type. Rows that fit are those `read_csv` gives, and nothing is read as null in silence. The
    lines are parsed once and staged, since both results read them.
    """
    whole = StructType([*schema.fields, StructField(REJECTED, StringType())])
    rows = spark.read.schema(whole).option("header", header).option(
        "columnNameOfCorruptRecord", REJECTED).option("mode", "PERMISSIVE").csv(path)
    rows = stage(rows, "csv")
    return rows.where(F.col(REJECTED).isNull()).drop(REJECTED), rows.where(F.col(REJECTED).isNotNull()).select(F.col(REJECTED).alias("line"))


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_documents(spark: SparkSession, path: str, schema: StructType = schemas.ORDER_DOCUMENTS) -> DataFrame:
    """Nested documents as JSON lines; internal fields such as `_id` are not in the schema or are dropped."""
    return drop_internal(read_json(spark, path, schema))


def read_whole_documents(
    spark: SparkSession, path: str, schema: StructType = schemas.ORDER_DOCUMENTS, others: str = "others"
) -> DataFrame:
    """Nested documents as JSON lines with all their fields but `_id`.

    The fields of `schema` are columns of their own; `others` maps the names of all further ones to
    VARIANT values of any shape (`variant_get(others['name'], '$.path', 'type')`), null where a
    document has none. A line that is no JSON object gives nulls.
    """
    lines = spark.read.text(path)
    known = F.array(*[F.lit(n) for n in [*schema.names, "_id"]])
    fields = F.from_json("value", "map<string, variant>")
    rest = F.map_filter(fields, lambda name, _: ~F.array_contains(known, name))
    read = lines.select(F.from_json("value", schema).alias("d"), F.when(F.size(rest) > 0, rest).alias(others))
    return read.select("d.*", others)


def read_with_fallback(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame | None:
    """JSON from the first path that exists, or None."""
    return next((read_json(spark, p, schema) for p in paths if path_exists(spark, p)), None)


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def flatten_orders(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Headers and item rows of nested orders."""
    headers = documents.select(*[c for c in documents.columns if c != "items"])
    items = documents.select("order_id", F.explode("items").alias("item")).select("order_id", "item.*")
    return headers, items


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(source, rows, needs_data) per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("source"), "rows", (F.col("rows") == 0).alias("needs_data"))
        for n, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str, compression: str | None = None) -> None:
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").json(path, compression=compression)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    with shuffles_dropped(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_sales(sales: DataFrame, path: str) -> None:
    """The fact by year and month, so that date filters prune folders.

    Rows are gathered by month before the write, which keeps the number of files down; a
    rebalance, unlike a plain repartition, lets Spark split a month that holds most rows.
    """
    dated = sales.withColumns({"year": F.year("date_key"), "month": F.month("date_key")})
    write_parquet(dated.hint("rebalance", "year", "month"), path, ["year", "month"])


_CURRENT = "CURRENT"


def write_star(spark: SparkSession, folder: str, dims: dict[str, DataFrame], sales: DataFrame) -> None:
    """Load dimensions and fact as a new version of the star and make it the current one.

    A version is a folder of its own. The last step renames a small file over `CURRENT`, which
    names the version and the one before: on file systems that rename atomically, readers find the
    old star whole until they find the new one. The version before stays for those who still read
    it; the one before that is deleted, and nothing that another load has not yet named. Of loads
    that end at the same time the last one counts, and the versions of the others stay behind.
    """
    root = folder.rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    for name, df in dims.items():
        write_parquet(df, f"{root}/{version}/{name}")
    write_sales(sales, f"{root}/{version}/fact_sales")
    before = _named_versions(spark, root)
    jvm = spark.sparkContext._jvm
    beside, path = (jvm.org.apache.hadoop.fs.Path(f"{root}/{x}") for x in (f".{_CURRENT}-{version}", _CURRENT))
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    fs = path.getFileSystem(configuration)
    out = fs.create(beside, True)
    try:
        out.write(bytearray("\n".join([version, *before[:1]]).encode()))
    finally:
        out.close()
    kinds = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    kinds[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), configuration).rename(beside, path, kinds)
    for old in before[1:]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{old}"), True)


def _named_versions(spark: SparkSession, root: str) -> list[str]:
    """The current version and the one before, as far as there are any."""
    if not path_exists(spark, f"{root}/{_CURRENT}"):
        return []
    return [r[0] for r in spark.read.text(f"{root}/{_CURRENT}", wholetext=True).select(F.explode(F.split("value", "\n"))).collect()]


def star_path(spark: SparkSession, folder: str, table: str) -> str:
    """Where a table of the current star lies."""
    root = folder.rstrip("/")
    versions = _named_versions(spark, root)
    if not versions:
        raise FileNotFoundError(f"no star was loaded to {folder}")
    return f"{root}/{versions[0]}/{table}"


def read_star(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(star_path(spark, folder, table))


def write_database(df: DataFrame, url: str, table: str, batch: int = 5000, properties: dict | None = None) -> None:
    """Replace the rows of a database table and keep its definition."""
    df.write.mode("overwrite").option("truncate", True).option("batchsize", batch).jdbc(url, table, properties=properties)


def write_bundle(bundle: dict[str, DataFrame], folder: str, writer: Callable[[DataFrame, str], None] = write_parquet) -> None:
    for name, df in bundle.items():
        writer(df, f"{folder.rstrip('/')}/{name}")


def latest_per_key(updates: DataFrame, key: str, order: list[str], partial: bool = False) -> DataFrame:
    """The last write per key, by `order` and then by all columns.

    With `partial`, a null is a field the document does not have, and every field takes the last
    write that has it. An aggregate with map-side combine, so a key written often stays cheap.
    """
    if partial:
        fields = [c for c in updates.columns if c != key]
        last = [F.max(F.when(F.col(c).isNotNull(), F.struct(*[o for o in order if o != c], c)))[c].alias(c) for c in fields]
        return updates.groupBy(key).agg(*last)
    rest = [c for c in updates.columns if c != key and c not in order]
    last = updates.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return last.select(key, *[F.col(f"_row.{c}").alias(c) for c in updates.columns if c != key])


def upsert(target: DataFrame, updates: DataFrame, key: str, order: list[str], partial: bool = False) -> DataFrame:
    """Documents after keyed upserts: fields of the update are set, the others kept, new keys added.

    The last write per key wins; documents without a key are one document. An update supplies all columns of `updates` except those of
    `order` that the target does not have; with `partial` it supplies only those not null.
    """
    last = latest_per_key(updates, key, order, partial).withColumn("_new", F.lit(True))
    supplied = [c for c in updates.columns if c != key and (c not in order or c in target.columns)]
    u, t = last.alias("u"), target.alias("t")
    columns = [F.coalesce(F.col(f"t.{key}"), F.col(f"u.{key}")).alias(key)]
    for c in dict.fromkeys([*[c for c in target.columns if c != key], *supplied]):
        if c not in supplied:
            columns.append(F.col(f"t.{c}").alias(c))
        elif c not in target.columns:
            columns.append(F.col(f"u.{c}").alias(c))
        elif partial:
            columns.append(F.coalesce(F.col(f"u.{c}"), F.col(f"t.{c}")).alias(c))
        else:
            columns.append(F.when(F.col("_new"), F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return t.join(u, F.col(f"t.{key}").eqNullSafe(F.col(f"u.{key}")), "full").select(*columns)
