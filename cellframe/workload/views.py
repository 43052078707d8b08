"""Matrices, vectors, tensors and graphs over the driver tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.model import CooMatrix, CooTensor, DenseRows, Vector

FIRST_YEAR = 1995
FACTOR_RANK = 4
# Given schemas save a look at the files before every query.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


class Tables:
    """Views of one scale-factor directory. All but ``x_sparse``, whose feature is its gaps, cover whole tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._sizes: dict[str, int] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            reader = self.spark.read.schema(SCHEMAS[name])
            self._tables[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def sizes(self, *names: str) -> tuple[int, ...]:
        """Sizes of id ranges (largest id + 1), those not yet known in one job."""
        missing = [n for n in dict.fromkeys(names) if n not in self._sizes]
        if missing:
            ids = [self._ids(n).select(F.lit(n).alias("name"), F.col("id").cast("bigint")) for n in missing]
            union = ids[0]
            for more in ids[1:]:
                union = union.unionByName(more)
            for row in union.groupBy("name").agg((F.max("id") + 1).alias("n")).collect():
                self._sizes[row["name"]] = row["n"]
        return tuple(self._sizes[n] for n in names)

    def _ids(self, name: str) -> DataFrame:
        if name == "month":
            return self.lines.select(F.col("month").alias("id"))
        table, column = {
            "part": ("part", "p_partkey"), "supplier": ("supplier", "s_suppkey"),
            "customer": ("customer", "c_custkey"), "vector": ("embeddings", "vec_id"),
            "label": ("embeddings", "label"),
        }[name]
        return self.table(table).select(F.col(column).alias("id"))

    def size(self, name: str) -> int:
        return self.sizes(name)[0]

    @property
    def lines(self) -> DataFrame:
        month = (F.year("l_shipdate") - FIRST_YEAR) * 12 + F.month("l_shipdate") - 1
        flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
        return self.table("lineitem").withColumn("month", month.cast("bigint")).withColumn(
            "flag", flag.cast("bigint"))

    def _matrix(self, i: str, j: str, rows: int, cols: int) -> CooMatrix:
        return CooMatrix(self.lines.select(
            F.col(i).alias("i"), F.col(j).alias("j"), F.col("l_quantity").alias("v")), rows, cols)

    @cached_property
    def a(self) -> CooMatrix:
        """Supplier x part, quantities, with duplicates."""
        return self._matrix("l_suppkey", "l_partkey", *self.sizes("supplier", "part"))

    @cached_property
    def b(self) -> CooMatrix:
        """Part x month."""
        return self._matrix("l_partkey", "month", *self.sizes("part", "month"))

    @cached_property
    def c_raw(self) -> CooMatrix:
        """Month x return flag, one cell per line item."""
        return self._matrix("month", "flag", self.size("month"), 3)

    @cached_property
    def c_sum(self) -> CooMatrix:
        """Month x return flag, summed."""
        summed = self.c_raw.df.groupBy("i", "j").agg(F.sum("v").alias("v"))
        return CooMatrix(summed, self.size("month"), 3, unique=True)

    @cached_property
    def x_sparse(self) -> Vector:
        """Size of the larger parts, by part."""
        part = self.table("part").where("p_size > 25")
        return Vector(part.select(F.col("p_partkey").alias("i"), F.col("p_size").cast("double").alias("v")),
                      self.size("part"), unique=True)

    @cached_property
    def x_dense(self) -> Vector:
        """Size of every part."""
        return Vector(self.table("part").select(
            F.col("p_partkey").alias("i"), F.col("p_size").cast("double").alias("v")),
            self.size("part"), dense=True, unique=True)

    @cached_property
    def x_short(self) -> Vector:
        """Nation of every supplier: a dense vector shorter than A is wide."""
        return Vector(self.table("supplier").select(
            F.col("s_suppkey").alias("i"), F.col("s_nationkey").cast("double").alias("v")),
            self.size("supplier"), dense=True, unique=True)

    @cached_property
    def d(self) -> DenseRows:
        """Part x four small whole-number measures."""
        row = F.array(*[c.cast("double") for c in (
            F.col("p_size"), F.length("p_name"), F.length("p_type"), F.length("p_brand"))])
        return DenseRows(self.table("part").select(F.col("p_partkey").alias("i"), row.alias("row")),
                         self.size("part"), 4)

    @cached_property
    def vectors(self) -> DenseRows:
        """The embeddings."""
        row = F.transform("embedding", lambda x: x.cast("double"))
        return DenseRows(self.table("embeddings").select(F.col("vec_id").alias("i"), row.alias("row")),
                         self.size("vector"), 64)

    @cached_property
    def label_members(self) -> CooMatrix:
        """Label x embedding, 1.0 where the embedding has the label."""
        return CooMatrix(self.table("embeddings").select(
            F.col("label").cast("bigint").alias("i"), F.col("vec_id").alias("j"), F.lit(1.0).alias("v")),
            *self.sizes("label", "vector"), unique=True)

    @cached_property
    def tensor3(self) -> CooTensor:
        """Supplier x part x month."""
        df = self.lines.select(F.col("l_suppkey").alias("i0"), F.col("l_partkey").alias("i1"),
                               F.col("month").alias("i2"), F.col("l_quantity").alias("v"))
        return CooTensor(df, self.sizes("supplier", "part", "month"))

    @cached_property
    def tensor4(self) -> CooTensor:
        """Supplier x part x month x line number (1 to 7)."""
        df = self.lines.select(
            F.col("l_suppkey").alias("i0"), F.col("l_partkey").alias("i1"), F.col("month").alias("i2"),
            (F.col("l_linenumber") - 1).cast("bigint").alias("i3"), F.col("l_quantity").alias("v"))
        return CooTensor(df, (*self.tensor3.shape, 7))

    @cached_property
    def tensor1(self) -> CooTensor:
        """Quantity by supplier, as a tensor of one mode."""
        df = self.lines.select(F.col("l_suppkey").alias("i0"), F.col("l_quantity").alias("v"))
        return CooTensor(df, (self.size("supplier"),))

    def factors(self, t: CooTensor) -> list[DenseRows]:
        """One whole-number factor per mode: F_m[i, r] = (7 i + 3 r + m) mod 11 - 5."""
        made = []
        for m, n in enumerate(t.shape):
            row = F.array(*[
                ((F.col("id") * 7 + 3 * r + m) % 11 - 5).cast("double") for r in range(FACTOR_RANK)])
            made.append(DenseRows(self.spark.range(n).select(F.col("id").alias("i"), row.alias("row")),
                                  n, FACTOR_RANK))
        return made

    @cached_property
    def graph(self) -> CooMatrix:
        """Trade between suppliers (ids from 0) and customers (ids after the suppliers).

        Every line item is an edge. A line item with flag A points from the supplier to the customer if the
        supplier's balance is not negative; all others point from the customer to the supplier.
        """
        n_suppliers, n_customers = self.sizes("supplier", "customer")
        orders = self.table("orders").select("o_orderkey", (F.col("o_custkey") + n_suppliers).alias("customer"))
        supplier = self.table("supplier").select("s_suppkey", "s_acctbal")
        sold = (self.table("lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
                .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
                .join(supplier, F.col("l_suppkey") == F.col("s_suppkey")))
        out = (F.col("l_returnflag") == "A") & (F.col("s_acctbal") >= 0)
        edges = sold.select(
            F.when(out, F.col("l_suppkey")).otherwise(F.col("customer")).alias("i"),
            F.when(out, F.col("customer")).otherwise(F.col("l_suppkey")).alias("j"), F.lit(1.0).alias("v"))
        n = n_suppliers + n_customers
        return CooMatrix(edges, n, n)
