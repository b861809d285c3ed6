"""Role tables (S1): the named inputs of the feature queries.

A *role* is what the feature queries read: contracts, contract items, tasks,
task history and the code tables.  ``Roles`` maps each role name to a lazily
built DataFrame, so the builders never know where the data comes from:

* ``table_roles``  - role tables stored as parquet/ORC/... (the production form);
* ``driver_roles`` - the role views derived from the generated TPC-H-like
  tables (``orders``, ``lineitem``, ``part``, ``supplier``, ``customer``), the
  mapping documented in FIXTURES.md; it is what the tests and the bench use;
* ``sources.jdbc.jdbc_roles`` - role tables read over JDBC.

Role tables are read under declared schemas (``ROLE_SCHEMAS``): every column is
cast to its type, a zero date becomes NULL, and what does not fit its type
(malformed text, a decimal too long for its places) becomes NULL and is counted.  The counts
are observed metrics of the very job that reads the rows, so they cost no second pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.session import sized_session

#: The columns and types of the roles.
ROLE_SCHEMAS = {
    "contract": "codigo long, idcontrato long, status int, assinatura date, cancelamento date, vencimento date",
    "item": "id_contrato long, item long, quantidade decimal(10,0), valor decimal(14,4)",
    "task": "cliente long, nros long, nros_sub int, data_cad date, data_exe date, categoria long, subcategoria long, "
    "prioridade int, para1 long, stos string, cod_ps int",
    "task_history": "nros long, datafos date",
    "user": "cod_usu long, grupo_trabalho int",
    "category": "st long, dst string",
    "status": "cod string, sto string, descr string",
    "item_dict": "codigo long, grupo_produto string",
    "registry": "cod_cad long, nomecli string, empresa string",
    "product": "cod_ps int",
}
#: What the original database writes for a date that is none.
ZERO_DATE = "0000-00-00"

ROLE_NAMES = (
    "contract",
    "item",
    "task",
    "task_history",
    "user",
    "category",
    "status",
    "item_dict",
    "registry",
    "product",
)

DRIVER_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


class Roles:
    """Lazy role -> DataFrame mapping; each role is built once per instance."""

    def __init__(self, spark: SparkSession, loaders: dict[str, Callable[[], DataFrame]]):
        missing = [r for r in ROLE_NAMES if r not in loaders]
        if missing:
            raise KeyError(f"roles without a loader: {missing}")
        self.spark = spark
        self._loaders = loaders
        self._built: dict[str, DataFrame] = {}

    def load(self, role: str) -> DataFrame:
        if role not in self._loaders:
            raise KeyError(f"unknown role {role!r}; known: {sorted(self._loaders)}")
        if role not in self._built:
            self._built[role] = self._loaders[role]()
        return self._built[role]

    def __getattr__(self, role: str) -> DataFrame:
        if role.startswith("_"):
            raise AttributeError(role)
        try:
            return self.load(role)
        except KeyError as exc:
            raise AttributeError(str(exc)) from exc

    def replace(self, **frames: DataFrame) -> "Roles":
        """A copy with some roles replaced by given DataFrames (tests, what-if runs)."""
        loaders = dict(self._loaders)
        for name, frame in frames.items():
            loaders[name] = (lambda f=frame: f)
        return Roles(self.spark, loaders)


def typed_role(df: DataFrame, role: str, observation: Observation | None = None) -> DataFrame:
    """``df`` under the role's schema; columns that the role has not are dropped.

    With ``observation`` the job that first runs the result also counts the rows
    (``rows``) and, for each column, the values that do not fit (``<column>_rejected``)
    and, for dates, the zero dates (``<column>_zero``).
    """
    columns, metrics = [], [F.count(F.lit(1)).alias("rows")]
    for field in T._parse_datatype_string(ROLE_SCHEMAS[role]).fields:
        raw, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        zero = raw.cast("string").startswith(ZERO_DATE) if kind == "date" else F.lit(False)
        value = F.when(~zero, raw.try_cast(kind)) if kind == "date" else raw.try_cast(kind)
        columns.append(value.alias(field.name))
        metrics.append(F.count_if(raw.isNotNull() & ~zero & raw.try_cast(kind).isNull()).alias(f"{field.name}_rejected"))
        if kind == "date":
            metrics.append(F.count_if(zero).alias(f"{field.name}_zero"))
    return (df.observe(observation, *metrics) if observation else df).select(*columns)


def table_roles(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", observations: dict[str, Observation] | None = None, **options: str) -> Roles:
    """Roles stored as tables, one path per role, read under the role schemas.

    ``observations`` holds one ``Observation`` for each role whose rejects are to
    be counted; ``options`` go to the reader (separator, header).
    """
    watched = observations or {}
    loaders = {role: (lambda r=role, p=path: typed_role(spark.read.format(fmt).options(**options).load(p), r, watched.get(r))) for role, path in paths.items()}
    return Roles(spark, loaders)


def frame_roles(spark: SparkSession, frames: dict[str, DataFrame]) -> Roles:
    """Roles given as ready DataFrames (unit tests with hand-made rows)."""
    return Roles(spark, {role: (lambda f=frame: f) for role, frame in frames.items()})


# ---------------------------------------------------------------------------
# Driver mapping: role views over the generated tables (FIXTURES.md section 2)
# ---------------------------------------------------------------------------


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, read as it lies; split sizes are the session's
    ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day(c: Column) -> Column:
    return c.cast("date")


def _status_codes_frame(spark: SparkSession) -> DataFrame:
    # Fixed code table of the mapping: task status code, status value, description.
    rows = [
        ("AF", "X", "DONE"),
        ("AO", "V", "CHECKED"),
        ("NF", "X", "CANCELLED"),
        ("NO", "P", "OPEN"),
        ("RF", "X", "BILLING"),
        ("RO", "P", "WAIT RETORNO"),
    ]
    # a VALUES list has a known size, so Spark broadcasts it by itself; rows handed over by
    # createDataFrame have none, and all tasks would be shuffled by their few status codes
    values = ", ".join(f"('{cod}', '{sto}', '{descr}')" for cod, sto, descr in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS status(cod, sto, descr)")


def _product_code(p_type: Column) -> Column:
    return F.when(p_type == "PROMO", 67).when(p_type == "ECONOMY", 18).otherwise(0)


def driver_roles(spark: SparkSession, sf_dir: str) -> Roles:
    """Role views over the driver's generated tables, in a session whose shuffles are
    dealt by the number of lines (a count that Parquet answers from its footers)."""
    spark = sized_session(spark, read_driver_table(spark, sf_dir, "lineitem").count())
    tables: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame:
        if name not in tables:
            tables[name] = read_driver_table(spark, sf_dir, name)
        return tables[name]

    def contract() -> DataFrame:
        o = table("orders")
        last_ship = table("lineitem").groupBy("l_orderkey").agg(_day(F.max("l_shipdate")).alias("last_ship"))
        j = o.join(last_ship, o["o_orderkey"] == last_ship["l_orderkey"], "left")
        status = (
            F.when(F.col("o_orderstatus") == "P", F.lit(9))
            .when(
                (F.col("o_orderstatus") == "O")
                & (_day(F.col("o_orderdate")) >= F.lit("2000-01-01").cast("date")),
                F.lit(3),
            )
            .otherwise(F.lit(4))
        )
        return j.select(
            F.col("o_custkey").alias("codigo"),
            F.col("o_orderkey").alias("idcontrato"),
            status.alias("status"),
            _day(F.col("o_orderdate")).alias("assinatura"),
            F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("date"))
            .otherwise(F.col("last_ship"))
            .alias("cancelamento"),
            F.date_add(_day(F.col("o_orderdate")), 365).alias("vencimento"),
        )

    def item() -> DataFrame:
        l = table("lineitem")
        valor = (
            F.col("l_extendedprice").cast("decimal(12,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
        ).cast("decimal(14,4)")
        return l.select(
            F.col("l_orderkey").alias("id_contrato"),
            F.col("l_partkey").alias("item"),
            F.col("l_linenumber").cast("decimal(10,0)").alias("quantidade"),
            valor.alias("valor"),
        )

    def task() -> DataFrame:
        l = table("lineitem")
        o = table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        p = table("part").select("p_partkey", "p_type")
        j = l.join(o, l["l_orderkey"] == o["o_orderkey"]).join(p, l["l_partkey"] == p["p_partkey"])
        cad = _day(F.col("o_orderdate"))
        exe = F.when(
            (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 1),
            F.lit(None).cast("date"),
        ).otherwise(F.date_add(cad, F.col("l_quantity").cast("int") - 3))
        prio = (
            F.when(F.col("l_discount") >= 0.1, 9)
            .when(F.col("o_orderpriority").startswith("1"), 3)
            .when(F.col("o_orderpriority").startswith("2"), 4)
            .when(F.col("o_orderpriority").startswith("3"), 2)
            .when(F.col("o_orderpriority").startswith("4"), 0)
            .otherwise(1)
        )
        return j.select(
            F.col("o_custkey").alias("cliente"),
            F.col("l_orderkey").alias("nros"),
            F.when(F.col("l_linenumber") <= 5, 0).otherwise(1).alias("nros_sub"),
            cad.alias("data_cad"),
            exe.alias("data_exe"),
            F.col("l_partkey").alias("categoria"),
            F.col("l_partkey").alias("subcategoria"),
            prio.alias("prioridade"),
            F.col("l_suppkey").alias("para1"),
            F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("stos"),
            _product_code(F.col("p_type")).alias("cod_ps"),
        )

    def task_history() -> DataFrame:
        return table("lineitem").select(
            F.col("l_orderkey").alias("nros"), _day(F.col("l_shipdate")).alias("datafos")
        )

    def user() -> DataFrame:
        return table("supplier").select(
            F.col("s_suppkey").alias("cod_usu"), F.col("s_nationkey").alias("grupo_trabalho")
        )

    def category() -> DataFrame:
        return table("part").select(F.col("p_partkey").alias("st"), F.col("p_name").alias("dst"))

    def item_dict() -> DataFrame:
        return table("part").select(
            F.col("p_partkey").alias("codigo"), F.col("p_type").alias("grupo_produto")
        )

    def registry() -> DataFrame:
        c = table("customer")
        return c.select(
            F.col("c_custkey").alias("cod_cad"),
            F.when(F.col("c_custkey") % 5 == 0, F.lit(None).cast("string"))
            .otherwise(F.col("c_name"))
            .alias("nomecli"),
            F.col("c_mktsegment").alias("empresa"),
        )

    def product() -> DataFrame:
        return table("part").select(_product_code(F.col("p_type")).alias("cod_ps")).distinct()

    loaders = {
        "contract": contract,
        "item": item,
        "task": task,
        "task_history": task_history,
        "user": user,
        "category": category,
        "status": lambda: _status_codes_frame(spark),
        "item_dict": item_dict,
        "registry": registry,
        "product": product,
    }
    return Roles(spark, loaders)
