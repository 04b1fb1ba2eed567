"""Each clause of the definitions matters on the test tables: dropping or changing it changes the text's answer."""

from __future__ import annotations

import oracle
import oracle_texts
import pytest
from conftest import TESTDATA

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="needs the test tables")

CHANGES = {
    "sales_range": [
        ("and cod_art <> 723", ""),
        ("between date '1998-04-01'", "between date '1998-04-02'"),
        ("and date '1998-06-30'", "and date '1998-06-29'"),
        ("where tiponum = 'BD'", "where tiponum <> 'BD'"),
        ("fecha_factura is not null and", ""),
        ("in ('FA', 'NC', 'ND', 'PE')", "in ('FA', 'NC', 'ND', 'PE', 'RE')"),
        ("prove = 3 and", ""),
        ("and baja = 0", ""),
        ("where unidades <> 0", ""),
        ("case when l_linenumber = 7 then o_orderdate::date + 1 else o_orderdate::date end", "o_orderdate::date"),
        ("using (comprobante, fecha, empresa_id)", "using (comprobante, fecha)"),
        ("left join motivo", "join motivo"),
        ("left join ramo_equivalencia", "join ramo_equivalencia"),
        ("left join tipo_cliente", "join tipo_cliente"),
        ("left join vendedor", "join vendedor"),
        ("coalesce(tipo, 8)", "tipo"),
        ("coalesce(referencia, '')", "referencia"),
        ("when convertida >= 0 and left(comprobante, 2) = 'ND' then 'DE'", ""),
        ("numero + 1", "numero"),
    ],
    "sales_since": [
        ("fecha >= date", "fecha > date"),
        ("prove = 3 and", ""),
        ("fecha_factura is not null and", ""),
        ("where unidades <> 0", ""),
        ("'Apellido Vendedor'", "'Nombre Vendedor'"),
    ],
    "sales_by_alias": [
        ("where codigosinonimo <> ''", ""),
        ("and baja = 0", ""),
        ("fecha_factura is not null and", ""),
        ("prove = 3 and", ""),
        ("join tipo_cliente", "left join tipo_cliente"),
        ("case when left(referencia, 2)", "case when left(comprobante, 2)"),
        ("* inv_uxbcompra", ""),
        ("where convertida <> 0", ""),
    ],
    "inventory_units": [
        ("and cod_art <> 723", ""),
        ("prove = 3 and", ""),
        ("and baja = 0", ""),
        ("deposito_id = 0 and", ""),
        ("cantidad else 0 end", "cantidad else -1 end"),
    ],
    "inventory_boxes": [("* inv_uxbcompra", ""), ("::decimal(18,2)), 0)", "::decimal(18,2)), 1)")],
    "inventory_alias_units": [
        ("sum(stocktot::decimal(18,2))", "sum(stocktot)"),
        ("where codigosinonimo <> ''", ""),
        ("numero  from", "numero + 1 from"),
    ],
    "inventory_alias_boxes": [("* inv_uxbcompra", ""), ("and baja = 0", "")],
    "customer_master": [
        ("codigo > 0 and", ""),
        ("and estado = 'A'", ""),
        ("case when geoy = 0 then '' else geoy::varchar end", "geoy::varchar"),
        ("geox::varchar", "geoy::varchar"),
    ],
    "pending_deliveries": [("<= 3", "<= 2"), ("<= 3", "<= 8"), ("p.kind in ('inv', 'vta') and", "")],
    "backlog_numbers": [("fecha < p.created", "fecha <= p.created"), ("max_by", "min_by")],
    "mark_delivered": [("08:00:00", "09:00:00")],
    "due_gate": [("is distinct from", "=")],
    "advance_sequence": [("tiponum = 'JJ'", "tiponum = 'BD'")],
}
CASES = [(name, *change) for name, changes in CHANGES.items() for change in changes]


@pytest.fixture(scope="module")
def database():
    return oracle.duckdb_over(str(TESTDATA / "sf0.01"))


@pytest.mark.parametrize("name, old, new", CASES)
def test_change_is_noticed(database, name, old, new):
    text = oracle_texts.texts()[name]
    assert old in text
    changed = text.replace(old, new)
    assert oracle.expected(database, text)[1] != oracle.expected(database, changed)[1]
