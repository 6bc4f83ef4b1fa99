"""Table schemas of the evidence store, and the helpers that create tables and check rows against them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The sources, in reporting order.
SOURCES = ("hackernews", "appstore", "reddit")

_S, _TS, _L, _D = T.StringType(), T.TimestampType(), T.LongType(), T.DecimalType(38, 18)


def _table(**columns: tuple[T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, not required) for name, (kind, required) in columns.items()])


_ids, _vector = T.ArrayType(_S), T.ArrayType(T.FloatType())

#: A normalised document, as every source delivers it.
DOCUMENT = _table(source=(_S, True), source_id=(_S, True), url=(_S, True), author_handle=(_S, False), title=(_S, False), body=(_S, True),
                  created_at=(_TS, True), engagement=(_S, True), raw=(_S, True))

TABLES: dict[str, T.StructType] = {
    "documents": T.StructType([T.StructField("id", _S, False), *DOCUMENT.fields[:7], T.StructField("ingested_at", _TS, False), *DOCUMENT.fields[7:]]),
    "source_cursors": _table(source=(_S, True), cursor=(_S, True), updated_at=(_TS, True)),
    "embeddings": _table(id=(_S, True), document_id=(_S, True), model=(_S, True), vector=(_vector, True), created_at=(_TS, True)),
    "pain_points": _table(id=(_S, True), source_document_ids=(_ids, True), problem_statement=(_S, True), domain=(_S, False), intensity_signal=(_S, False),
                          workarounds=(_S, True), existing_tools=(_S, True), evidence_spans=(_S, True), created_at=(_TS, True)),
    "clusters": _table(id=(_S, True), source_document_ids=(_ids, True), label=(_S, False), centroid=(_vector, False), created_at=(_TS, True)),
    "cluster_members": _table(id=(_S, True), cluster_id=(_S, True), pain_point_id=(_S, True), created_at=(_TS, True)),
    "scores": _table(id=(_S, True), cluster_id=(_S, True), frequency=(_D, False), intensity=(_D, False), recency=(_D, False), source_diversity=(_D, False),
                     solution_gap=(_D, False), composite=(_D, True), computed_at=(_TS, True)),
    "briefs": _table(id=(_S, True), cluster_id=(_S, True), source_document_ids=(_ids, True), content=(_S, True), created_at=(_TS, True)),
    "runs": _table(id=(_S, True), stage=(_S, True), status=(_S, True), started_at=(_TS, True), finished_at=(_TS, False), input_tokens=(_L, False), output_tokens=(_L, False),
                   model=(_S, False), cost_usd=(T.DecimalType(10, 4), False), counts=(_S, True), errors=(_S, True)),
}

#: Unique keys, kept by the writers in operators.store.
KEYS = {"documents": ("source", "source_id"), "source_cursors": ("source",), "embeddings": ("document_id", "model"), "cluster_members": ("cluster_id", "pain_point_id")}

#: (table, column) -> table that it points to; array columns hold several keys.
REFERENCES = {
    ("embeddings", "document_id"): "documents", ("pain_points", "source_document_ids"): "documents", ("clusters", "source_document_ids"): "documents",
    ("cluster_members", "cluster_id"): "clusters", ("cluster_members", "pain_point_id"): "pain_points", ("scores", "cluster_id"): "clusters",
    ("briefs", "cluster_id"): "clusters", ("briefs", "source_document_ids"): "documents",
}


def create_tables(spark: SparkSession, base: str) -> list[str]:
    """Writes an empty table for each schema that has none under ``base``; forward only, so existing ones stay as they are."""
    made = []
    for name, schema in TABLES.items():
        try:
            spark.read.parquet(f"{base}/{name}").schema
        except Exception as error:  # no table there yet
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            spark.createDataFrame([], schema).write.parquet(f"{base}/{name}")
            made.append(name)
    return made


def document_id(source="source", source_id="source_id"):
    """The id of a document: made from its key, so that a replay makes it again."""
    return F.sha2(F.concat_ws("\u001f", source, source_id), 256)


def reachable(spark: SparkSession, target: str = "documents") -> DataFrame:
    """The tables from which references lead to ``target``, by a recursive query over REFERENCES."""
    edges = spark.createDataFrame([(t, to) for (t, _), to in REFERENCES.items()], "child string, parent string")
    return spark.sql("""
        WITH RECURSIVE walk(name) AS (
          SELECT DISTINCT child FROM {edges} WHERE parent = {target}
          UNION ALL SELECT e.child FROM walk JOIN {edges} e ON e.parent = walk.name)
        SELECT DISTINCT name FROM walk""", edges=edges, target=target)


def orphans(children: DataFrame, column: str, parents: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``children`` with a reference that ``parents`` doesn't have; array columns are checked entry by entry."""
    kind = children.schema[column].dataType
    each = children.withColumn("_ref", F.explode(column) if isinstance(kind, T.ArrayType) else F.col(column))
    return each.join(parents.select(F.col(key).alias("_ref")), "_ref", "left_anti").drop("_ref").dropDuplicates()


def columns(spark: SparkSession) -> DataFrame:
    """The catalogue of all tables: name, column, kind and whether it may be null."""
    rows = [(name, f.name, f.dataType.simpleString(), f.nullable) for name, schema in TABLES.items() for f in schema.fields]
    return spark.createDataFrame(rows, "name string, column string, kind string, nullable boolean")


def closure(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Each table (``name``) with each other one (``root``) that it leads to by ``edges`` (child, parent), in any number of steps; cycles are an error of the recursion limit."""
    return spark.sql("""
        WITH RECURSIVE walk(name, root) AS (
          SELECT child, parent FROM {edges}
          UNION ALL SELECT e.child, walk.root FROM walk JOIN {edges} e ON e.parent = walk.name)
        SELECT DISTINCT name, root FROM walk""", edges=edges)


def null_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """For each table and column (``name``, ``col``) how many rows it is null in, by one pass a table."""
    def counted(name: str, table: DataFrame) -> DataFrame:
        each = [F.struct(F.lit(name).alias("name"), F.lit(c).alias("col"), F.count_if(F.col(c).isNull()).alias("missing")) for c in table.columns]
        return table.agg(F.array(*each).alias("_all")).select(F.inline("_all"))

    return reduce(DataFrame.unionByName, [counted(*t) for t in tables.items()])
