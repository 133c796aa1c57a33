"""Typed scans of the shared tables (explicit schemas, never inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                        ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S),
                      ("value", _D), ("props", _S)),
    "documents": _schema(("doc_id", _L), ("text", _S), ("lang", _S), ("source", _S), ("n_chars", _L)),
    "labels": _schema(("doc_id", _L), ("quality", _I), ("toxic", _I)),
    "embeddings": _schema(("vec_id", _L), ("embedding", T.ArrayType(T.FloatType(), True)), ("label", _I)),
    "pages": _schema(("page_id", _L), ("url", _S), ("html", _S)),
    "benchmark": _schema(("item_id", _L), ("text", _S)),
    "conversations": _schema(("conv_id", _L), ("turn", _L), ("role", _S), ("text", _S)),
}

# A total order over lineitem rows: (l_orderkey, l_linenumber) alone is not unique.
LINEITEM_ROW_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    "l_extendedprice", "l_quantity")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet`` with its declared schema."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
