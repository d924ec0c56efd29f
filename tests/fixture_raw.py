"""A tiny raw layer in the reference's source shapes (two snapshots where the
source republishes history), built to exercise every model and trap T1-T4."""

import datetime as dt

from pyspark.sql import functions as F

from peerscope.sources.contracts import OLIST, PIX

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def _df(spark, contract, rows, date=D1):
    return spark.createDataFrame(rows, contract.schema).withColumn("ingestion_date", F.lit(date))


def _mun(i, nome, uf, uf_nome, macro_sigla, macro):
    return (i, nome, i * 10, f"imediata {i}", i * 100, f"intermediaria {i}", i % 50, uf, uf_nome, 3, macro_sigla,
            macro, float(i * 7), f"micro {i}", float(i * 3), f"meso {i}")


MUN_SCHEMA = ("id_municipio long, nome_municipio string, regiao_imediata_id long, regiao_imediata_nome string, "
              "regiao_interm_id long, regiao_interm_nome string, uf_id long, uf_sigla string, uf_nome string, "
              "macroregiao_id long, macroregiao_sigla string, macroregiao_nome string, microrregiao_id double, "
              "microrregiao_nome string, mesorregiao_id double, mesorregiao_nome string")
SIDRA_SCHEMA = ", ".join(f"{c} string" for c in ["NC", "NN", "MC", "MN", "V", "D1C", "D1N", "D2C", "D2N", "D3C",
                                                 "D3N", "D4C", "D4N", "D5C", "D5N", "D6C", "D6N"])


def _sidra(mun, var, value, year="2022"):
    return ("6", "Município", "45", "Pessoas", value, str(mun), "m", var, f"var {var}", year, year, "6794", "Total",
            None, None, None, None)


def build(spark):
    raw = {}
    old = [_mun(1, "Sao Paulo velho", "SP", "São Paulo", "SE", "Sudeste"), _mun(9, "Removido", "RJ", "Rio", "SE",
                                                                                "Sudeste")]
    new = [_mun(1, "São Paulo", "SP", "São Paulo", "SE", "Sudeste"), _mun(2, "Rio Branco", "AC", "Acre", "N", "Norte"),
           _mun(3, "Pequenópolis", "MG", "Minas Gerais", "SE", "Sudeste")]
    raw["ibge_localidades"] = (spark.createDataFrame(old, MUN_SCHEMA).withColumn("ingestion_date", F.lit(D1))
                               .unionByName(spark.createDataFrame(new + new[:1], MUN_SCHEMA)
                                            .withColumn("ingestion_date", F.lit(D2))))

    def sidra(rows_old, rows_new):
        return (spark.createDataFrame(rows_old, SIDRA_SCHEMA).withColumn("ingestion_date", F.lit(D1))
                .unionByName(spark.createDataFrame(rows_new, SIDRA_SCHEMA).withColumn("ingestion_date", F.lit(D2))))

    raw["ibge_censo_9514"] = sidra([_sidra(1, "93", "1")], [_sidra(1, "93", "250000"), _sidra(2, "93", "9999"),
                                                            _sidra(2, "93", "9999")])
    raw["ibge_censo_10295"] = sidra([_sidra(1, "13431", "1")], [
        _sidra(1, "13431", "3000"), _sidra(1, "13534", "2000"), _sidra(2, "13431", "1000"),
        _sidra(2, "13534", "800")])
    raw["ibge_censo_9936"] = sidra([_sidra(1, "x", "1")], [_sidra(1, "x", "80"), _sidra(2, "x", "60")])

    def pix(mun, ym, base):
        return (ym, float(mun), f"m{mun}", 35.0, "UF", "SE", "SUDESTE",
                base * 1.0, base, base * 2.0, base * 2, base * 3.0, base * 3, base * 4.0, base * 4,
                base, base, base, base)
    pix_rows = [pix(m, ym, 10 * m + k) for m in (1, 2, 3) for k, ym in enumerate([202211, 202212, 202301])]
    raw["bcb_pix"] = (spark.createDataFrame([pix(1, 202211, 1)], PIX.schema).withColumn("ingestion_date", F.lit(D1))
                      .unionByName(spark.createDataFrame(pix_rows, PIX.schema).withColumn("ingestion_date", F.lit(D2))))

    global GEO, CUST, ORDERS, ITEMS, PAYMENTS, REVIEWS, PRODUCTS, SELLERS, MUN_NEW, PIX_ROWS, CENSUS_NEW
    geo = [(1000, -23.5, -46.6, "são paulo", "SP"), (1000, -23.7, -46.8, "sao paulo", "SP"),
           (1000, -23.6, -46.7, "são paulo", "SP"), (1000, -23.6, -46.7, "são paulo", "SP"),
           (2000, -9.9, -67.8, "rio branco", "ac"), (3000, -15.0, -40.0, "pequenópolis", "MG")]
    raw["olist_geolocation"] = _df(spark, OLIST["geolocation"], geo)
    cust = [("c1", "u1", 1000, "sao paulo", "SP"), ("c2", "u2", 1000, "sao paulo", "SP"),
            ("c3", "u3", 2000, "rio branco", "AC"), ("c4", "u4", 3000, "pequenópolis", "MG"),
            ("c5", "u1", 1000, "sao paulo", "SP")]
    raw["olist_customers"] = _df(spark, OLIST["customers"], cust)
    o = [("o1", "c1", "delivered", "2018-03-01 10:00:00", "2018-03-01 12:00:00", None, "2018-03-05 09:00:00",
          "2018-03-10 00:00:00"),
         ("o2", "c2", "delivered", "2018-04-01 10:00:00", "2018-04-02 00:30:00", None, "2018-04-20 09:00:00",
          "2018-04-15 00:00:00"),
         ("o3", "c5", "canceled", "2018-05-01 10:00:00", None, None, None, "2018-05-20 00:00:00"),
         ("o4", "c3", "delivered", "2018-06-01 10:00:00", "2018-06-01 11:00:00", None, "2018-06-03 10:00:00",
          "2018-06-10 00:00:00"),
         ("o5", "c4", "delivered", "2018-07-01 10:00:00", "2018-07-01 11:00:00", None, "2018-07-04 10:00:00",
          "2018-07-20 00:00:00"),
         ("o6", "c1", "delivered", "2016-12-31 10:00:00", None, None, None, "2017-01-20 00:00:00"),
         ("o7", "c3", "shipped", "2017-05-05 10:00:00", "not a date", None, None, "2017-05-20 00:00:00"),
         ("o8", "c3", "canceled", "2018-08-01 10:00:00", None, None, "2018-08-02 10:00:00", "2018-08-30 00:00:00")]
    raw["olist_orders"] = _df(spark, OLIST["orders"], o)
    items = [("o1", 1, "p1", "s1", "2018-03-02 00:00:00", 100.0, 10.0), ("o1", 2, "p2", "s2", "2018-03-02 00:00:00",
                                                                          50.0, 5.0),
             ("o2", 1, "p1", "s1", "2018-04-02 00:00:00", 200.0, 20.0), ("o3", 1, "p3", "s1", "x", 30.0, 3.0),
             ("o4", 1, "p2", "s2", "2018-06-02 00:00:00", 80.0, 8.0), ("o5", 1, "p1", "s1", "2018-07-02 00:00:00",
                                                                       40.0, 4.0),
             ("o7", 1, "p3", "s2", "2017-05-06 00:00:00", 10.0, 1.0), ("o8", 1, "p3", "s2", "2018-08-01 00:00:00",
                                                                       5.0, 1.0)]
    raw["olist_order_items"] = _df(spark, OLIST["order_items"], items)
    pay = [("o1", 1, "credit_card", 3, 165.0), ("o2", 1, "boleto", 1, 220.0), ("o3", 1, "credit_card", 1, 33.0),
           ("o4", 1, "credit_card", 2, 50.0), ("o4", 2, "voucher", 1, 38.0), ("o5", 1, "boleto", 1, 44.0),
           ("o7", 1, "boleto", 1, 11.0), ("o8", 1, "boleto", 1, 6.0)]
    raw["olist_order_payments"] = _df(spark, OLIST["order_payments"], pay)
    rev = [("r1", "o1", 5, None, None, "2018-03-06 00:00:00", "2018-03-06 10:00:00"),
           ("r1b", "o1", 1, None, "velho", "2018-03-06 00:00:00", "sem data"),
           ("r2", "o2", 2, "ruim", "atrasou\nmuito", "2018-04-21 00:00:00", "2018-04-21 10:00:00"),
           ("r4", "o4", 4, None, None, "2018-06-04 00:00:00", "2018-06-04 10:00:00")]
    raw["olist_order_reviews"] = _df(spark, OLIST["order_reviews"], rev)
    prod = [("p1", "beleza", 10.0, 100.0, 1.0, 500.0, 10.0, 10.0, 10.0),
            ("p2", "beleza", 12.0, 90.0, 2.0, 300.0, 5.0, 4.0, 3.0),
            ("p3", "moveis", None, None, None, None, None, None, None)]
    raw["olist_products"] = _df(spark, OLIST["products"], prod)
    sellers = [("s1", 1000, "são paulo", "SP"), ("s2", 2000, "rio branco", "AC")]
    raw["olist_sellers"] = _df(spark, OLIST["sellers"], sellers)
    GEO, CUST, ORDERS, ITEMS, PAYMENTS, REVIEWS, PRODUCTS, SELLERS = geo, cust, o, items, pay, rev, prod, sellers
    MUN_NEW, PIX_ROWS = new, pix_rows
    CENSUS_NEW = {
        "9514": [_sidra(1, "93", "250000"), _sidra(2, "93", "9999")],
        "10295": [_sidra(1, "13431", "3000"), _sidra(1, "13534", "2000"), _sidra(2, "13431", "1000"),
                  _sidra(2, "13534", "800")],
        "9936": [_sidra(1, "x", "80"), _sidra(2, "x", "60")],
    }
    return raw


def write_landing(spark, folder):
    """The fixture's newest snapshot as landed files (business CSVs, API JSON dumps)."""
    import csv
    import json
    import os

    build(spark)
    os.makedirs(folder, exist_ok=True)
    tables = {"customers": CUST, "orders": ORDERS, "order_items": ITEMS, "order_payments": PAYMENTS,
              "order_reviews": REVIEWS, "geolocation": GEO, "products": PRODUCTS, "sellers": SELLERS}
    for key, rows in tables.items():
        c = OLIST[key]
        with open(os.path.join(folder, c.file_name), "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f)
            w.writerow([n for n, _, _ in c.fields])
            for r in rows:
                w.writerow(["" if v is None else v for v in r])
    muns = []
    for m in MUN_NEW:
        muns.append({"id": m[0], "nome": m[1],
                     "microrregiao": {"id": int(m[12]), "nome": m[13],
                                      "mesorregiao": {"id": int(m[14]), "nome": m[15]}},
                     "regiao-imediata": {"id": m[2], "nome": m[3], "regiao-intermediaria": {
                         "id": m[4], "nome": m[5], "UF": {"id": m[6], "sigla": m[7], "nome": m[8],
                                                          "regiao": {"id": m[9], "sigla": m[10], "nome": m[11]}}}}})
    with open(os.path.join(folder, "municipios.json"), "w", encoding="utf-8") as f:
        json.dump(muns, f)
    cols = [c.split()[0] for c in SIDRA_SCHEMA.split(", ")]
    for table, rows in CENSUS_NEW.items():
        header = {c: c for c in cols}
        header["V"] = "Valor"
        recs = [header] + [{k: v for k, v in zip(cols, r) if v is not None} for r in rows]
        with open(os.path.join(folder, f"censo_{table}.json"), "w", encoding="utf-8") as f:
            json.dump(recs, f)
    names = [n for n, _, _ in PIX.fields]
    with open(os.path.join(folder, "pix.json"), "w", encoding="utf-8") as f:
        json.dump({"value": [dict(zip(names, r)) for r in PIX_ROWS]}, f)
