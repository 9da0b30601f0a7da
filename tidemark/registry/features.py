"""Feature preparation, with vectors shown as plain columns."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.features import (
    assembler,
    category_table,
    check_categories,
    feature_stages,
    in_first_part,
    index_categories,
    index_to_string as back_to_string,
    one_hot_encoder,
    string_indexer,
)
from tidemark.sources.files import read_table


def entries(vector: str, size: int, prefix: str) -> list[Column]:
    array = vector_to_array(vector)
    return [F.get(array, F.lit(i)).alias(f"{prefix}{i}") for i in range(size)]


def all_entries(vector: str) -> Column:
    """``position, entry``: a row for each entry, however many categories there are."""
    return F.posexplode(vector_to_array(vector)).alias("position", "entry")


def segments(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")


def string_index(spark: SparkSession, folder: str) -> DataFrame:
    """Indexes of two columns from one fit."""
    parts = read_table(spark, folder, "part").select("p_partkey", "p_type", "p_brand")
    check_categories(parts, ["p_type", "p_brand"])
    indexed = string_indexer(["p_type", "p_brand"]).fit(parts).transform(parts)
    return indexed.select("p_partkey", "p_type_index", "p_brand_index")


def string_index_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same indexes from tables of categories, which may have any length."""
    parts = read_table(spark, folder, "part").select("p_partkey", "p_type", "p_brand")
    for column in ("p_type", "p_brand"):
        table = category_table(parts, column, f"{column}_index")
        parts = index_categories(parts, table, column, f"{column}_index")
    return parts.select("p_partkey", "p_type_index", "p_brand_index")


def index_to_string(spark: SparkSession, folder: str) -> DataFrame:
    """The category behind each index that occurs."""
    customers = segments(spark, folder)
    model = string_indexer(["c_mktsegment"]).fit(customers)
    distinct = model.transform(customers).select("c_mktsegment_index").distinct()
    return back_to_string(model, "c_mktsegment_index", "value").transform(distinct)


def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    customers = segments(spark, folder)
    indexer = string_indexer(["c_mktsegment"], unseen="error")
    encoder = one_hot_encoder(indexer.getOutputCols(), unseen="error")
    encoded = Pipeline(stages=[indexer, encoder]).fit(customers).transform(customers)
    return encoded.select("c_custkey", all_entries("c_mktsegment_vector"))


def assemble(spark: SparkSession, folder: str) -> DataFrame:
    """A scalar and a one-hot vector in one vector."""
    customers = segments(spark, folder)
    stages = feature_stages(["c_acctbal"], ["c_mktsegment"], unseen="error")
    assembled = Pipeline(stages=stages).fit(customers).transform(customers)
    return assembled.select("c_custkey", all_entries("features"))


def assemble_scalars(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    vectors = assembler(["l_quantity", "l_discount", "l_linenumber"]).transform(lines)
    return vectors.select("l_orderkey", *entries("features", 3, "f"))


def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    """Every order with the part it falls into."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.withColumn("part", F.when(in_first_part("o_orderkey"), "training").otherwise("holdout"))


QUERIES = {
    "string_index": string_index,
    "string_index_table": string_index_table,
    "index_to_string": index_to_string,
    "one_hot": one_hot,
    "assemble": assemble,
    "assemble_scalars": assemble_scalars,
    "hash_split": hash_split,
}


def ranked(table: str, column: str) -> str:
    return f"""
        SELECT {column}, (row_number() OVER (ORDER BY count(*) DESC, {column}) - 1)::DOUBLE AS idx
        FROM {table} GROUP BY {column}"""


# The last category has no entry.
FLAGS = f"""
    ranks AS ({ranked("customer", "c_mktsegment")}),
    places AS (SELECT idx AS place FROM ranks WHERE idx < (SELECT max(idx) FROM ranks)),
    flags AS (SELECT c_custkey, place::INTEGER AS position, (idx = place)::INTEGER::DOUBLE AS entry
              FROM customer JOIN ranks USING (c_mktsegment), places)"""

INDEXES = f"""
    SELECT p_partkey, t.idx AS p_type_index, b.idx AS p_brand_index
    FROM part JOIN ({ranked("part", "p_type")}) t USING (p_type)
              JOIN ({ranked("part", "p_brand")}) b USING (p_brand)"""

SQL = {
    "string_index": INDEXES,
    "string_index_table": INDEXES,
    "index_to_string": f"""
        SELECT idx AS c_mktsegment_index, c_mktsegment AS value
        FROM ({ranked("customer", "c_mktsegment")})""",
    "one_hot": f"""
        WITH {FLAGS} SELECT * FROM flags""",
    "assemble": f"""
        WITH {FLAGS}
        SELECT c_custkey, 0 AS position, c_acctbal AS entry FROM customer
        UNION ALL SELECT c_custkey, position + 1, entry FROM flags""",
    "assemble_scalars": """
        SELECT l_orderkey, l_quantity AS f0, l_discount AS f1, l_linenumber::DOUBLE AS f2
        FROM lineitem""",
    "hash_split": """
        SELECT o_orderkey, o_totalprice,
               CASE WHEN ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT % 10 < 8
                    THEN 'training' ELSE 'holdout' END AS part
        FROM orders""",
}
