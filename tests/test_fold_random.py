"""fold_offers against a brute-force reading of its definition on random
small inputs (many rows per client, ties, missing phones)."""

import random

import pytest

from offerline.operators import fold_offers
from test_operators import FOLD_SCHEMA

COLS = ("code", "phone", "product", "base", "address", "price", "lim", "sla", "mode", "term")
HEAD = {"code": "VEDI_COD_CLI", "phone": "fone_1", "product": "VEDI_DSC_MAT", "base": "Base",
        "address": "endereco_concatenado", "price": "Novo Preço Final (R$/l)", "lim": "Novo Preço Final Limite",
        "sla": "SLA DE ENTREGA", "mode": "VEDI_DSC_ICT", "term": "Dias De Prazo"}


def _rows(seed):
    rnd = random.Random(seed)
    out, seen = [], set()
    for client in range(3):
        for _ in range(rnd.randint(1, 12)):
            product = rnd.choice("ABCD")
            phone = rnd.choice([None, "551", "552", "553"])
            if (client, product, phone) in seen:  # rows after the arg-min: one per (product, phone)
                continue
            seen.add((client, product, phone))
            out.append(dict(name=f"C{client}", grp="G", company=client, product=product, phone=phone,
                            code=rnd.randint(1, 4), price=float(rnd.randint(1, 3)), lim=float(rnd.randint(1, 3)),
                            sla=rnd.choice("XY"), mode=rnd.choice("UV"), term=rnd.choice("79"),
                            base=rnd.choice("PQ"), address=rnd.choice(["a1", "a2"])))
    return out


def _order(r):
    return (r["product"], r["phone"] is None, r["phone"] or "")


def _distinct(values):
    out = []
    for v in values:
        if v not in out:
            out.append(v)
    return out


def _brute(rows, mode):
    result = {}
    for client in sorted({r["company"] for r in rows}):
        rs = sorted((r for r in rows if r["company"] == client), key=_order)
        got = {}
        if mode == "positional":
            for c in ("code", "phone", "product", "address", "price", "lim"):
                vals = _distinct([r[c] for r in rs])
                got.update({f"{c}_{i}": vals[i - 1] if len(vals) >= i else None for i in (1, 2, 3)})
            for c in ("sla", "mode", "term", "base"):
                got.update({f"{c}_{i}": rs[i - 1][c] if len(rs) >= i else None for i in (1, 2, 3)})
        else:
            for c in ("code", "phone"):
                vals = _distinct([r[c] for r in rs])
                got.update({f"{c}_{i}": vals[i - 1] if len(vals) >= i else None for i in (1, 2, 3)})
            best = []
            for p in sorted({r["product"] for r in rs}):
                best.append(min((r for r in rs if r["product"] == p), key=lambda r: (r["lim"], _order(r))))
            for c in COLS:
                if c not in ("code", "phone"):
                    got.update({f"{c}_{i}": best[i - 1][c] if len(best) >= i else None for i in (1, 2, 3)})
        if got["phone_1"] is not None:
            result[client] = got
    return result


@pytest.mark.parametrize("mode", ["positional", "aligned"])
@pytest.mark.parametrize("seed", range(4))
def test_fold_matches_brute_force(spark, mode, seed):
    rows = _rows(seed)
    data = [(r["name"], r["grp"], r["company"], r["product"], r["phone"], r["code"], r["price"], r["lim"],
             r["sla"], r["mode"], r["term"], r["base"], r["address"]) for r in rows]
    folded = fold_offers(spark.createDataFrame(data, FOLD_SCHEMA), mode=mode).collect()
    got = {r["CNPJ_BASICO"]: {f"{c}_{i}": r[f"{HEAD[c]}_{i}"] for c in COLS for i in (1, 2, 3)} for r in folded}
    assert got == _brute(rows, mode)
