"""The base tables as views over the order, line item, part and customer test tables.

FIXTURES.md gives the rules and the reason for each. Every table here is
derived from a given one and grows with it, apart from the two return reasons.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from despacho.sources.base import conform


VOUCHER = """
    case left(o_orderpriority, 1)
      when '1' then 'FA' when '2' then 'PE' when '3' then 'NC' when '4' then 'ND' else 'RE'
    end || lpad(cast(o_orderkey as string), 10, '0') as comprobante"""
SIGNED = "case when l_returnflag = 'R' then -l_quantity else l_quantity end"


def _venta(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        VOUCHER,
        "cast(o_orderdate as date) as fecha",
        "1 as empresa_id",
        "o_custkey as cod_cli",
        "o_custkey % 120 as cod_ven",
        "case o_orderstatus when 'F' then 1 when 'O' then 2 else 9 end as motivodev",
        """if(o_orderkey % 7 = 0, null,
              if(o_orderkey % 3 = 0, 'NC', 'FA') || lpad(cast(o_orderkey as string), 10, '0')) as referencia""",
        "if(o_orderkey % 11 = 0, null, cast(o_orderdate as date)) as fecha_factura",
    )


def _item_venta(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    # Each order once per possible date, so that a condition on fecha thins the orders before the join.
    day = "cast(o_orderdate as date)"
    dated = orders.selectExpr("o_orderkey", "0 as late", f"{day} as fecha", VOUCHER).unionAll(
        orders.selectExpr("o_orderkey", "1 as late", f"date_add({day}, 1) as fecha", VOUCHER)
    )
    lines = lineitem.selectExpr(
        "l_orderkey as o_orderkey",
        "if(l_linenumber = 7, 1, 0) as late",
        "if(l_linenumber = 6, 2, 1) as empresa_id",
        "l_partkey as cod_art",
        f"cast({SIGNED} as decimal(18,2)) as cantidad",
        f"cast(if(l_quantity > 45, 0, {SIGNED}) as decimal(18,2)) as cantidad_uni",
    )
    return lines.join(dated, ["o_orderkey", "late"])


def _articulo(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey as codigo",
        "p_name as codigoprov",
        "p_size % 5 as prove",
        "if(p_size > 45, 1, 0) as baja",
        "cast(if(p_partkey % 17 = 0, 0, p_size) as decimal(18,2)) as uxb",
        "cast(case p_partkey % 3 when 0 then 1 when 1 then 2 else 4 end as decimal(18,2)) as uxbcompra",
    )


def _sinonimo(part: DataFrame) -> DataFrame:
    return part.selectExpr("p_partkey as codigoart", "if(p_partkey % 10 = 0, '', p_type) as codigosinonimo")


def _cliente(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "c_custkey as codigo",
        "c_name as razon_social",
        "c_mktsegment as localidad",
        "lpad(cast(c_custkey % 10000 as string), 4, '0') as cp",
        "'Calle ' || cast(c_custkey % 500 as string) as direccion",
        "'30-' || lpad(cast(c_custkey as string), 10, '0') || '-' || cast(c_custkey % 10 as string) as cuit",
        "cast(if(c_custkey % 9 = 0, 0, c_acctbal) as decimal(12,6)) as geoy",
        "cast(if(c_custkey % 13 = 0, null, c_acctbal) as decimal(12,6)) as geox",
        "c_nationkey as ramo",
        "if(c_mktsegment = 'BUILDING', 'B', 'A') as estado",
    )


def _stockhistorico(lineitem: DataFrame) -> DataFrame:
    shift = "case l_linenumber % 4 when 0 then 0.005 when 2 then -0.005 else 0.000 end"
    return lineitem.selectExpr(
        "l_partkey as articulo_codigo",
        "cast(l_shipdate as date) as fecha",
        "l_linenumber % 2 as deposito_id",
        f"cast(cast({SIGNED} as decimal(17,4)) + {shift} as decimal(18,4)) as stocktot",
    )


def _numeracion(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        "cast(greatest(s_suppkey, 1) as int) as sucursal",
        "case s_suppkey when 0 then 'JJ' when 1 then 'BD' else 'FA' end as tiponum",
        "if(s_suppkey <= 1, 'X', 'A') as letra",
        "1 as empresa_id",
        "cast(case s_suppkey when 0 then 7 when 1 then 41 else 898 + s_suppkey end as int) as numero",
    )


def _configuracion(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        "cast(s_suppkey as int) as codigo",
        "cast(76 + s_suppkey as int) as codigo_distribuidor",
        "cast((s_suppkey + 2) % 5 as int) as codigo_proveedor",
        "date '1995-01-01' as fecha_inicio",
        "'dist' || lpad(cast(s_suppkey as string), 4, '0') as usuario",
        "'08:00' as hora_envio",
        "date_add(date '1998-05-11', cast(s_suppkey % 5 as int)) as ult_envio",
    )


class _Lazy(Mapping):
    """Tables built on first use, so that a query opens only the files it reads."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders, self._built = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


_schemas: dict[str, StructType] = {}


def sample_tables(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    """All base tables over the test tables in ``folder``."""

    @cache
    def given(name: str) -> DataFrame:
        path = f"{folder}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = spark.read.parquet(path).schema
        return spark.read.schema(_schemas[path]).parquet(path)

    builders = {
        "venta": lambda: _venta(given("orders")),
        "item_venta": lambda: _item_venta(given("lineitem"), given("orders")),
        "articulo": lambda: _articulo(given("part")),
        "sinonimo": lambda: _sinonimo(given("part")),
        "cliente": lambda: _cliente(given("customer")),
        "ramo": lambda: given("nation").selectExpr("n_nationkey as codigo"),
        "ramo_equivalencia": lambda: given("nation")
        .filter("n_nationkey % 6 <> 0")
        .selectExpr("n_nationkey as codigo", "n_regionkey as id_tipo"),
        "tipo_cliente": lambda: given("region")
        .filter("r_regionkey <> 4")
        .selectExpr("r_regionkey as id", "r_regionkey + 1 as codigo"),
        "vendedor": lambda: given("supplier").selectExpr("s_suppkey as codigo", "s_name as nombre"),
        "motivo": lambda: spark.sql(
            "select * from values (1, 'DEVOLUCION'), (2, 'ERROR DE CARGA') as motivo(codigo, descripcion)"
        ),
        "stockhistorico": lambda: _stockhistorico(given("lineitem")),
        "numeracion": lambda: _numeracion(given("supplier")),
        "configuracion": lambda: _configuracion(given("supplier")),
    }
    return _Lazy({name: partial(_conformed, name, build) for name, build in builders.items()})


def _conformed(name: str, build: Callable[[], DataFrame]) -> DataFrame:
    return conform(name, build())


def sample_packages(t: Mapping[str, DataFrame], as_of: str) -> DataFrame:
    """Packages created by ``as_of``: one per kind and business date in the vouchers or the stock."""
    sold = t["venta"].select("fecha").distinct()
    stocked = t["stockhistorico"].select("fecha").distinct()
    packages = (
        sold.select(F.explode(F.array(F.lit("vta"), F.lit("mc"))).alias("kind"), "fecha")
        .unionByName(stocked.select(F.lit("inv").alias("kind"), "fecha"))
        .select(
            "kind",
            F.col("fecha").alias("business_date"),
            F.date_add("fecha", 1 + F.dayofmonth("fecha") % 3).alias("created"),
        )
    )
    return packages.filter(F.col("created") <= F.lit(as_of).cast("date"))


def sample_ledger(packages: DataFrame) -> DataFrame:
    """Three of four packages delivered, at midnight of the day they were created."""
    return packages.filter(F.dayofmonth("business_date") % 4 != 0).select(
        "kind", "business_date", F.col("created").cast("timestamp_ntz").alias("sent_at")
    )
