import csv
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.models import train, trees
from ledgerloom.plans import asset_sales as job
from ledgerloom.plans import values as v
from ledgerloom.sources import columns, tables

FIRMS = [("Ardita Ndërtim SH.P.K.", "Shoqëri me përgjegjësi", 4120), ("Bora Trade L.L.C.", "Shoqëri me përgjegjësi të kufizuara", 4711), ("Cema", "Biznes individual", 111)]


def write(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows(rows)


@pytest.fixture(scope="module")
def enriched(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sheets")
    rng = random.Random(4)
    sales = [["x"] * 16, v.SALES_SHEET]
    buyers = ["Ardita Ndertim shpk", "Bora Trade", "Cema", "Trade Bora LLC", "Dikush Tjeter"]
    for i in range(1, 121):
        kind = ["Lokal", "Tokë", "Depo dhe tokë"][i % 3]
        sales.append([
            str(i), "R1", f"P{i}", f"N{i % 4}", f"Asset {i}", kind, "Tender", "" if i % 4 == 0 else f"{50 + i},5", "" if i % 5 == 0 else f"1.{100 + i},00",
            f"Komuna{i % 2}", "Qytet", f"Zone{i % 6}", "Aset", f"{rng.randint(1, 9)},{rng.randint(100, 999)}.00", buyers[i % 5], f"{i % 27 + 1}/0{i % 9 + 1}/2015",
        ])
        if i % 10 == 0:
            sales.append([""] * 4 + ["part two"] + [""] * 11)
        if i % 25 == 0:
            sales.append(v.SALES_SHEET)
            sales.append([" "] * 16)
    rents = [v.RENT_SHEET]
    for i in range(1, 21):
        rents.append([str(i), "R2", "N1", f"Prona {i}", "Rruga 1 fsh. Dardhe" if i % 2 else "Rruga 2", "Komuna1", "Cema", ["Tokë", "Lokal"][i % 2], str(10 * i), "100", "5/6/2016", "mujore" if i % 2 else "vjetore"])
    write(folder / "sales.csv", sales)
    write(folder / "rents.csv", rents)
    sales_df = job.sales_records(tables.read_grid(spark, str(folder / "sales.csv"), v.SALES_SHEET))
    rents_df = job.rent_records(tables.read_grid(spark, str(folder / "rents.csv"), v.RENT_SHEET))
    registry = spark.createDataFrame([
        (i, name, f"Pronar {name};1000;{50 + i}", f"{code},{code + 5};Pune,Tjeter;P,S", str(i), kind, "044", "e@x", "w.x", str(3 + i), str(1000 * i + 500), "2010-03-04", "", "Aktiv")
        for i, (name, kind, code) in enumerate(FIRMS)
    ], ["row_id", *v.REGISTRY_COLUMNS])
    combined = job.combine(sales_df, rents_df)
    return sales_df, rents_df, combined, job.enrich(combined, registry)


def test_sheets_become_records(enriched):
    sales, rents, _, _ = enriched
    assert sales.count() == 120 and rents.count() == 20
    row = sales.filter(F.col("`PAK ID`") == "P10").first()
    assert row["Emri i Ndërmarrjes së Re apo Asetit në Likuidim"] == "Asset 10 part two"
    assert sales.filter(F.col("`PAK ID`") == "P3").first()["Sipërfaqja e tokës në metra katror"] == 1103.0


def test_rents_are_converted(enriched):
    _, _, combined, _ = enriched
    assert [r[0] for r in combined.select(F.col("`Nr.`")).orderBy(F.col("`Nr.`")).collect()] == list(range(1, 141))
    row = combined.filter(F.col("`PAK ID`") == "RENT_3").first().asDict()
    assert (row["Nr."], row["Cmimi i shitjes së asetit"], row["[m2]"]) == (123, 18000.0, 30.0)
    assert row["Qytet apo Fshat (lokacioni i asetit të shitur)"] == "Fshat" and row["Mënyra e shitjes"] == "Konvertuar nga qira me ROI 15 vjet"
    land = combined.filter(F.col("`PAK ID`") == "RENT_4").first().asDict()
    assert (land["[m2]"], land["Sipërfaqja e tokës në metra katror"], land["Cmimi i shitjes së asetit"]) == (None, 40.0, 1500.0)


def test_buyers_are_enriched(enriched):
    _, _, combined, wide = enriched
    assert wide.count() == combined.count()
    got = {r["Blerësi"]: r.asDict() for r in wide.collect()}
    assert got["Ardita Ndertim shpk"]["ARBK_MatchField"] == "EmriBiznesit_exact"
    assert got["Trade Bora LLC"]["ARBK_MatchField"] == "EmriBiznesit_fuzzy" and got["Trade Bora LLC"]["ARBK_MatchScore"] == 100.0
    assert got["Dikush Tjeter"]["ARBK_MatchField"] == "" and got["Dikush Tjeter"]["ARBK_MatchScore"] is None
    assert got["Cema"]["ARBK_Aktiviteti_2_KodiNace"] == "116" and got["Cema"]["ARBK_Pronari_1"] == "Pronar Cema"


@pytest.fixture(scope="module")
def prepared(enriched):
    raw = columns.normalize_columns(enriched[3]).withColumnRenamed("m2", v.OBJECT_AREA)
    return job.prepare(raw)


def test_prepared_table_is_complete(prepared):
    table, report = prepared.table, prepared.report
    assert report.value("rows", "initial") == "140" and report.value("rows", "target_present") == "92"
    kept = set(table.columns)
    assert not kept & {*v.LEAKAGE, *v.IDENTIFIERS, *v.DATES}
    assert {"total_area_m2", "asset_structure_type", "capital_to_sale_price_ratio", "business_age_days_at_sale", v.PROFILE} <= kept
    assert {r[0] for r in table.select(v.PROFILE).distinct().collect()} == {"llc__industrial_ops", "llc__commercial_services", "individual__primary"}
    assert int(report.value("rows", "final")) == table.count() == 92


def test_split_is_written(spark, prepared, tmp_path):
    learn, held_out = job.load(prepared, str(tmp_path))
    assert learn.count() + held_out.count() == prepared.table.count()
    assert spark.read.json(str(tmp_path / "report")).filter("metric = 'test'").count() == 1
    assert spark.read.parquet(str(tmp_path / "train")).count() == learn.count()


def test_models_train_and_rank(prepared):
    cols = job.model_columns(prepared.table)
    assert v.TARGET not in cols.categorical and v.PROFILE not in cols.categorical
    fitted = train.fit(prepared.table, cols, trees.random_forest(trees=5, depth=4))
    assert fitted.score(prepared.table).filter(F.col("predicted") == F.col(v.PROFILE)).count() > 70
    ranker = job.fit_ranker(prepared.table, v.TARGET, trees.random_forest(trees=5, depth=4))
    ranked = job.rank_candidates(ranker, prepared.table.limit(3), ["row_id"], k=2)
    assert ranked.count() == 6 and ranked.filter("rank = 1 and probability > 0").count() == 3
