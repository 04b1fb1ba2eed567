"""The extract definitions spelled out row by row in plain Python, to compare with."""

from __future__ import annotations

from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal


def _round(value: Decimal, places: int) -> Decimal:
    return value.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP).quantize(Decimal("0.01"))


def _sum(values):
    known = [v for v in values if v is not None]
    return sum(known, Decimal(0)) if known else None


def _convert(quantity, per_box, per_purchase):
    if None in (quantity, per_box, per_purchase):
        return None
    return (quantity * per_box / per_purchase).quantize(Decimal("0.000001"), ROUND_HALF_UP)


def _left_rows(table, key, value, empty):
    found = [row for row in table if value is not None and row[key] == value]
    return found or [empty]


def _header(t, offset):
    [config] = [c for c in t["configuracion"] if c["codigo"] == 1]
    [number] = [
        n["numero"] for n in t["numeracion"]
        if (n["sucursal"], n["tiponum"], n["letra"], n["empresa_id"]) == (1, "BD", "X", 1)
    ]
    return config["codigo_distribuidor"], number + offset


def _sales_rows(t, supplier, start, end, excluded, alias, types_required, seller):
    for _ in (n for n in t["numeracion"] if n["tiponum"] == "BD"):
        for v in t["venta"]:
            if v["comprobante"][:2] not in ("FA", "NC", "ND", "PE") or v["fecha_factura"] is None:
                continue
            if v["fecha"] < start or (end is not None and v["fecha"] > end):
                continue
            for line in t["item_venta"]:
                if any(line[k] != v[k] for k in ("comprobante", "fecha", "empresa_id")) or line["cod_art"] is None:
                    continue
                if excluded is not None and line["cod_art"] == excluded:
                    continue
                for art in t["articulo"]:
                    if art["codigo"] != line["cod_art"] or art["prove"] != supplier or art["baja"] != 0:
                        continue
                    names = [art["codigoprov"]]
                    if alias:
                        names = [
                            s["codigosinonimo"] for s in t["sinonimo"]
                            if s["codigoart"] == art["codigo"] and (s["codigosinonimo"] or "").rstrip(" ") != ""
                        ]
                    for name in names:
                        for reason in _left_rows(t["motivo"], "codigo", v["motivodev"], {"descripcion": None}):
                            for cli in t["cliente"]:
                                if cli["codigo"] != v["cod_cli"]:
                                    continue
                                for branch in t["ramo"]:
                                    if branch["codigo"] != cli["ramo"]:
                                        continue
                                    for bridge in _left_rows(
                                        t["ramo_equivalencia"], "codigo", branch["codigo"], {"id_tipo": None}
                                    ):
                                        for kind in _left_rows(t["tipo_cliente"], "id", bridge["id_tipo"], {"codigo": None}):
                                            if types_required and kind["codigo"] is None:
                                                continue
                                            sellers = (
                                                _left_rows(t["vendedor"], "codigo", v["cod_ven"], {"nombre": None})
                                                if seller else [{"nombre": None}]
                                            )
                                            for s in sellers:
                                                key = (
                                                    v["fecha"], v["comprobante"], v["referencia"], v["cod_cli"],
                                                    v["cod_ven"], name, reason["descripcion"], kind["codigo"], s["nombre"],
                                                )
                                                yield key, _convert(line["cantidad"], art["uxb"], art["uxbcompra"]), line["cantidad_uni"]


def _sales_groups(*args):
    groups = defaultdict(list)
    for key, conv, units in _sales_rows(*args):
        groups[key].append((conv, units))
    for key, values in groups.items():
        yield key, _sum(c for c, _ in values), _sum(u for _, u in values)


def _type(net, prefix, order, codes):
    if net is not None and net >= 0 and prefix in order:
        return codes[0]
    if net is not None and net >= 0 and prefix == "ND":
        return codes[1]
    return codes[2]


def current_sales(t, supplier, start, end, excluded, seller):
    out = Counter()
    for key, conv, units in _sales_groups(t, supplier, start, end, excluded, False, False, seller):
        if units is None or units == 0:
            continue
        day, voucher, ref, cli, ven, name, reason, kind, seller_name = key
        first, last = (seller_name, seller_name) if seller else ("Nombre Vendedor", "Apellido Vendedor")
        out[(
            *_header(t, 1), cli, 8 if kind is None else kind, ven, first, last, name, "PC", day.isoformat(),
            _type(conv, voucher[:2], ("FR", "FA", "PE"), ("OR", "DE", "CR")), _round(units, 0), voucher,
            (ref or "") if voucher[:2] == "NC" else "", reason,
        )] += 1
    return out


def alias_sales(t, supplier, start, end):
    out = Counter()
    for key, conv, _ in _sales_groups(t, supplier, start, end, None, True, True, False):
        if conv is None or conv == 0:
            continue
        day, voucher, ref, cli, ven, name, reason, kind, _ = key
        out[(
            *_header(t, 0), day, voucher, "", ref if (ref or "")[:2] == "NC" else None, cli, kind, ven, name,
            _round(conv, 2), _type(conv, voucher[:2], ("FA", "PE"), ("FC", "ND", "NC")), reason,
        )] += 1
    return out


def stock(t, supplier, start, end, excluded, alias, boxes):
    groups = defaultdict(list)
    for s in t["stockhistorico"]:
        if s["deposito_id"] != 0 or not start <= s["fecha"] <= end:
            continue
        for art in t["articulo"]:
            if art["codigo"] != s["articulo_codigo"] or art["prove"] != supplier or art["baja"] != 0:
                continue
            if excluded is not None and art["codigo"] == excluded:
                continue
            names = [art["codigoprov"]]
            if alias:
                names = [
                    x["codigosinonimo"] for x in t["sinonimo"]
                    if x["codigoart"] == art["codigo"] and (x["codigosinonimo"] or "").rstrip(" ") != ""
                ]
            amount = s["stocktot"]
            if amount is not None:
                amount = _round(amount, 2)
                if boxes:
                    amount = None if art["uxbcompra"] is None else _round(amount / art["uxbcompra"], 2)
            for name in names:
                groups[(name, s["fecha"])].append((s["stocktot"], amount))
    out = Counter()
    for (name, day), values in groups.items():
        raw, amount = _sum(r for r, _ in values), _sum(a for _, a in values)
        quantity = Decimal("0.00")
        if raw is not None and raw > 0:
            quantity = None if amount is None else _round(amount, 2 if alias else 0)
        if alias:
            out[(*_header(t, 0), day, name, quantity)] += 1
        else:
            out[(*_header(t, 1), name, "PC", day.isoformat(), 1, "UNI", quantity)] += 1
    return out


def customers(t):
    def text(value):
        return None if value is None else "" if value == 0 else str(value.quantize(Decimal("0.000001")))

    return Counter(
        (*_header(t, 1), c["codigo"], c["razon_social"], "", 6, c["localidad"], c["cp"], c["direccion"], "", c["cuit"],
         text(c["geoy"]), text(c["geox"]), c["ramo"])
        for c in t["cliente"] if c["codigo"] > 0 and c["estado"] == "A"
    )
