"""The asset-sales job: one configuration of the general operators.

Raw sheets are stitched, rents become sale equivalents, buyers are matched to
the registry, and the enriched table is prepared for training.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import dates, rules, text
from ledgerloom.functions import features as fx
from ledgerloom.models import serve, train
from ledgerloom.models.features import AssetFeatures
from ledgerloom.operators import dedup, filters, impute, match, outliers, ranking, split, watch
from ledgerloom.operators.order_stats import medians_of
from ledgerloom.plans import values as v
from ledgerloom.session import cut_lineage
from ledgerloom.sources import columns, sheets, tables
from ledgerloom.sources.reports import StepReport, write_report

ROW = "row_id"


# ---- preparation ------------------------------------------------------------

def sales_records(grid: DataFrame) -> DataFrame:
    """Stitched and typed sales, with an order column."""
    records = sheets.stitch_records(grid, v.SALES_SHEET, v.SALES_HEADINGS)
    area, land, price, date, number = (v.SALES_SHEET[i] for i in (7, 8, 13, 15, 0))
    typed = {number: text.parse_float, area: text.locale_number, land: text.locale_number, price: text.locale_number, date: dates.parse_day_first}
    return cut_lineage(_with_order(sheets.type_records(records, typed)).select(ROW, *[F.col(f"`{c}`") for c in v.SALES_SHEET]))


def rent_records(grid: DataFrame) -> DataFrame:
    records = sheets.stitch_records(grid, v.RENT_SHEET, v.RENT_HEADINGS)
    number, area, amount, date = (v.RENT_SHEET[i] for i in (0, 8, 9, 10))
    typed = {number: text.parse_float, area: text.locale_number, amount: text.locale_number, date: dates.parse_day_first}
    return cut_lineage(_with_order(sheets.type_records(records, typed)).select(ROW, *[F.col(f"`{c}`") for c in v.RENT_SHEET]))


def _with_order(records: DataFrame) -> DataFrame:
    """Consecutive order of records across sources, blocks and positions.

    Blocks of one source hold a bounded number of records each.
    """
    sized = records.withColumn("__block", F.struct("source", F.col("record.block")))
    return ranking.number_within(sized, "__block", F.col("record.pos"), ROW).drop("__block")


def convert_rents(rents: DataFrame, start: int) -> DataFrame:
    """Rent records as sale-equivalent records numbered from ``start``."""
    number, region, firm, asset, address, town, tenant, category, area, amount, date, period = (F.col(f"`{c}`") for c in v.RENT_SHEET)
    years = rules.return_years(category, v.RETURN_YEARS, v.DEFAULT_RETURN_YEARS)
    yearly = rules.annual_amount(amount, period, v.PERIOD_FACTORS)
    house, land = rules.route_area(category, area, v.LAND_WORDS, v.OBJECT_WORDS)
    key = F.coalesce(number.cast("long"), F.col(ROW)).cast("string")
    cells = [
        F.col(ROW) + F.lit(start - 1), text.clean_spaces(region), F.concat(F.lit("RENT_"), key), text.clean_spaces(firm), text.clean_spaces(asset),
        text.clean_spaces(category), F.concat(F.lit(v.CONVERTED_METHOD[0]), years.cast("string"), F.lit(v.CONVERTED_METHOD[1])), house, land,
        text.clean_spaces(town), rules.place_kind(address, town, v.VILLAGE_MARKER, v.VILLAGE, v.CITY), text.clean_spaces(address),
        F.lit(v.CONVERTED_SALE_TYPE), rules.money(yearly * years), text.clean_spaces(tenant), date,
    ]
    return rents.select(F.col(ROW), *[c.alias(n) for c, n in zip(cells, v.SALES_SHEET)])


def combine(sales: DataFrame, rents: DataFrame) -> DataFrame:
    """Sales, then converted rents, renumbered 1..n."""
    number = v.SALES_SHEET[0]
    last = sales.agg(F.max(F.col(f"`{number}`")).alias("m"), F.max(ROW).alias("r")).first()
    converted = convert_rents(rents, int(last["m"] or 0) + 1).withColumn(ROW, F.col(ROW) + F.lit(last["r"] or 0))
    converted = converted.withColumn(number, F.col(f"`{number}`").cast("double"))
    both = sales.unionByName(converted)
    return cut_lineage(ranking.number_rows(both.drop(number), ROW, number).select(ROW, *[F.col(f"`{c}`") for c in v.SALES_SHEET]))


def enrich(sales: DataFrame, registry: DataFrame, fuzzy: bool = True) -> DataFrame:
    """Sales with the registry fields of the buyer's best match; '' where there is none."""
    name, owner, activity, *rest = v.REGISTRY_COLUMNS
    registry = columns.add_missing(registry, {c: "string" for c in v.REGISTRY_COLUMNS}, fill="")
    registry = match.prepare_registry(registry, name, owner)
    tiers = [match.Tier("business_norm", v.MATCH_FIELDS["business_exact"]), match.Tier("owner_norm", v.MATCH_FIELDS["owner_exact"])]
    if fuzzy:
        tiers += [
            match.Tier("business_norm", v.MATCH_FIELDS["business_fuzzy"], v.BUSINESS_MATCH),
            match.Tier("owner_norm", v.MATCH_FIELDS["owner_fuzzy"], v.OWNER_MATCH),
        ]
    buyer = v.SALES_SHEET[14]
    found = match.match_names(sales.select(F.trim(F.col(f"`{buyer}`")).alias("name")), registry, tiers, ROW)
    parsed, activities = text.owner_fields(F.col(f"`{owner}`")), text.activity_fields(F.col(f"`{activity}`"))
    outputs = {f"ARBK_{c}": F.col(f"`{c}`").cast("string") for c in rest}
    for part, label in [("owner", "Pronari_1"), ("capital", "Pronari_1_Kapitali"), ("percent", "Pronari_1_KapitaliPerqindje")]:
        outputs[f"ARBK_{label}"] = parsed[part]
    outputs["ARBK_EmriBiznesit_Gjetur"] = F.col(f"`{name}`")
    for i in range(5):
        for part, label in [("code", "KodiNace"), ("description", "Pershkrimi"), ("type", "LlojiAktivitetit")]:
            outputs[f"ARBK_Aktiviteti_{i + 1}_{label}"] = activities[i][part]
    rows = sales.withColumn("__buyer", F.trim(F.col(f"`{buyer}`")))
    joined = match.enrich(rows, "__buyer", found, registry, ROW, outputs, {})
    return joined.drop("__buyer").withColumnsRenamed({"field": "ARBK_MatchField", "score": "ARBK_MatchScore"})


# ---- preparation of the training table --------------------------------------

@dataclass
class Prepared:
    table: DataFrame
    report: StepReport = field(default_factory=StepReport)


def asset_masks(df: DataFrame):
    return rules.asset_masks(text.joined_text([c for c in v.ASSET_TEXT if c in df.columns]), v.LAND_PATTERN, v.OBJECT_PATTERN, v.MIXED_PATTERN)


def prepare(raw: DataFrame) -> Prepared:
    """Normalised enriched table with a ``row_id`` to a model-ready table."""
    report = StepReport()
    columns.require_columns(raw, [v.BUSINESS_TYPE, v.TARGET, ROW])
    df = raw.withColumns({f.name: text.null_if_missing(f.name) for f in raw.schema.fields if isinstance(f.dataType, T.StringType)})
    has_kind, has_target = F.col(v.BUSINESS_TYPE).isNotNull(), F.col(v.TARGET).isNotNull()
    sizes = df.agg(F.count(F.lit(1)).alias("a"), F.count_if(has_kind).alias("b"), F.count_if(has_kind & has_target).alias("c")).first()
    for name, n in zip(["initial", "business_type_present", "target_present"], sizes):
        report.add("rows", name, n)
    distinct = dedup.drop_full_duplicates(filters.drop_null(filters.drop_null(df, v.BUSINESS_TYPE), v.TARGET), ROW)
    distinct = cut_lineage(distinct)
    df = cut_lineage(_typed(dedup.keep_first(distinct, v.DUPLICATE_KEY, ROW)))
    report.add("duplicates", "full_row", sizes["c"] - (full := distinct.count()))
    report.add("duplicates", "business_key", full - df.count())

    df = _infer_areas(df, report)
    df = _features(df)
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name != ROW]
    df = cut_lineage(df)
    stats = outliers.iqr_stats(df, numeric, v.NON_NEGATIVE_TOKENS, exclude=[v.TARGET, v.BUSINESS_TYPE])
    for c, facts in stats.items():
        for metric, value in facts.items():
            report.add("outliers", metric, value, c)
    df = cut_lineage(_drop_columns(outliers.iqr_flags(df, stats), report))
    df = cut_lineage(_profile(_fill(df, report), report))
    before, kept = df, filters.keep_allowed(df, v.PROFILE, v.ALLOWED_PROFILES)
    report.add("profiles", "before", sorted(r[0] for r in before.select(v.PROFILE).distinct().collect()))
    filters.assert_no_null(kept)
    kept = filters.drop_rare(kept, v.TARGET, v.RARE_TARGET)
    kept, dates_dropped = columns.drop_present(kept, v.DATES)
    kept = cut_lineage(kept)
    report.add("columns", "dates_dropped", dates_dropped)
    report.add("profiles", "after", sorted(r[0] for r in kept.select(v.PROFILE).distinct().collect()))
    report.add("rows", "final", kept.count())
    report.add("columns", "final", len(kept.columns) - 1)
    return Prepared(kept, report)


def _typed(df: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numbers = {c: text.clean_numeric(c) if isinstance(kinds[c], T.StringType) else F.col(c).cast("double") for c in v.NUMERIC_LIKE if c in kinds}
    stamps = {c: dates.parse_timestamp(c) if isinstance(kinds[c], T.StringType) else F.col(c).cast("timestamp_ntz") for c in v.DATES if c in kinds}
    return df.withColumns({**numbers, **stamps})


def _infer_areas(df: DataFrame, report: StepReport) -> DataFrame:
    if not {v.OBJECT_AREA, v.LAND_AREA} <= set(df.columns):
        return df.withColumns(asset_masks(df))
    open_before = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in (v.OBJECT_AREA, v.LAND_AREA)]).first()
    for c in (v.OBJECT_AREA, v.LAND_AREA):
        report.add("area_inference", "missing", open_before[c], c)
    return impute.infer_areas(df, v.OBJECT_AREA, v.LAND_AREA, asset_masks(df), v.AREA_LEVELS, v.AREA_GROUP_SIZE)


def _features(df: DataFrame) -> DataFrame:
    has = set(df.columns)
    areas = {v.OBJECT_AREA, v.LAND_AREA} <= has
    medians = medians_of(df, [c for c in (v.LAND_AREA, v.PRICE) if c in has])
    house, land, price = F.col(v.OBJECT_AREA), F.col(v.LAND_AREA), F.col(v.PRICE)
    if areas:
        df = df.withColumns({
            "total_area_m2": fx.row_sum([v.OBJECT_AREA, v.LAND_AREA]),
            "object_to_land_ratio": fx.guarded_ratio(fx.zero_if_null(house), fx.zero_if_null(land)),
            "is_land_only": fx.flag(F.col("land_only")),
            "has_object": fx.flag(~F.col("land_only") & (F.col("object_only") | F.col("mixed") | (fx.zero_if_null(house) > 0))),
            "is_large_land": fx.above(land, medians[v.LAND_AREA]),
            "area_data_completeness_score": F.col("raw_has_object_area") + F.col("raw_has_land_area"),
            "asset_structure_type": rules.masks_to_label({k: F.col(k) for k in v.STRUCTURE_LABELS}, v.STRUCTURE_LABELS, v.UNKNOWN_STRUCTURE),
        })
    if v.PRICE in has:
        out = {"log_sale_price": fx.log_amount(price), "is_high_value_asset": fx.above(price, medians[v.PRICE])}
        if areas:
            for name, area in [("total", F.col("total_area_m2")), ("land", land), ("object", house)]:
                out[f"price_per_{name}_m2"] = fx.guarded_ratio(price, area)
        if v.CAPITAL in has:
            out["capital_to_sale_price_ratio"] = fx.guarded_ratio(fx.zero_if_null(v.CAPITAL), price)
        if v.EMPLOYEES in has:
            out["sale_price_per_employee"] = fx.guarded_ratio(price, F.col(v.EMPLOYEES))
        df = df.withColumns(out)
        if areas:
            df = df.withColumn("area_price_interaction", fx.zero_if_null("total_area_m2") * fx.zero_if_null("price_per_total_m2"))
    if v.CONTRACT_DATE in has:
        df = df.withColumns(dates.calendar_parts(v.CONTRACT_DATE, "contract"))
        if v.REGISTERED_DATE in has:
            df = df.withColumn("business_age_days_at_sale", dates.age_days(v.CONTRACT_DATE, v.REGISTERED_DATE))
            df = df.withColumn("business_age_years_at_sale", dates.age_years("business_age_days_at_sale"))
    return df.drop("land_only", "object_only", "mixed")


def _drop_columns(df: DataFrame, report: StepReport) -> DataFrame:
    """Leaking, sparse, constant, dominated and identifying columns, judged in one pass.

    The three data-dependent rules look at single columns, so dropping for one
    does not change what another finds.
    """
    df, leaking = columns.drop_present(df, v.LEAKAGE)
    df = cut_lineage(df)
    facts = cut_lineage(filters.column_facts(df, [c for c in df.columns if c != ROW]))
    exempt = [v.TARGET, v.PROFILE]
    sparse = filters.names_in(filters.sparse_columns(facts, v.SPARSE_ABOVE, exempt))
    constant = [c for c in filters.names_in(filters.constant_columns(facts, exempt)) if c not in sparse]
    gone = {*sparse, *constant}
    dominant = [c for c in filters.names_in(filters.dominant_columns(facts, v.DOMINANT_SHARE, v.DOMINANT_VALUES, v.PROTECTED)) if c not in gone]
    df, identifying = columns.drop_present(df.drop(*sparse, *constant, *dominant), v.IDENTIFIERS)
    for name, found in [("leakage", leaking), ("sparse", sparse), ("constant", constant), ("dominant", dominant), ("identifier", identifying)]:
        report.add("columns", f"{name}_dropped", found)
    return df


def _fill(df: DataFrame, report: StepReport) -> DataFrame:
    missing = {c: n for c, n in filters.null_counts(df).items() if n}
    for c, n in missing.items():
        report.add("missing", "cells", n, c)
    df = df.withColumns(fx.missing_flags(v.MISSING_FLAGS, df.columns))
    df = impute.fill_constant(df, {c: 0.0 for c in v.ZERO_FILL if c in missing})
    df = impute.fill_matching(df, v.ACTIVITY_TOKEN, v.ACTIVITY_DEFAULT)
    df = impute.fill_constant(df, v.DEFAULTS)
    if v.CONTRACT_DATE in missing:
        df = impute.fill_dates(df, v.CONTRACT_DATE, constant=v.CONTRACT_CONSTANT)
    if v.REGISTERED_DATE in missing:
        df = impute.fill_dates(df, v.REGISTERED_DATE, other=v.CONTRACT_DATE, constant=v.REGISTERED_CONSTANT)
    grouped = [c for c in v.GROUP_FILL if c in missing and c not in v.ZERO_FILL]
    if grouped:
        df = impute.hierarchical_median_fill(df, grouped, v.BUSINESS_LEVELS, v.BUSINESS_GROUP_SIZE)
    return impute.fill_fallback(df, lambda c: v.ACTIVITY_DEFAULT if v.ACTIVITY_TOKEN in c else v.TEXT_DEFAULT)


def _profile(df: DataFrame, report: StepReport) -> DataFrame:
    kind = F.col(v.BUSINESS_KIND) if v.BUSINESS_KIND in df.columns else F.lit("")
    code = F.col(v.ACTIVITY_CODE) if v.ACTIVITY_CODE in df.columns else F.lit(None)
    group = rules.entity_group(kind, F.col(v.TARGET), v.ENTITY_RULES, v.COMPANY_TOKENS)
    macro = rules.roll_up(rules.range_bucket(code, v.ACTIVITY_RANGES, "unknown"), v.MACRO_GROUPS, "unknown")
    df = df.withColumn(v.PROFILE, rules.profile_label(group, macro))
    facts = df.agg(F.count_distinct(v.PROFILE), F.count_if(F.contains(v.PROFILE, F.lit("unknown")))).first()
    report.add("profiles", "created", facts[0])
    report.add("profiles", "unknown_rows", facts[1])
    return df


def load(prepared: Prepared, folder: str) -> tuple[DataFrame, DataFrame]:
    """Write the cleaned table, its split and the report; give back train and test."""
    learn, held_out = split.train_test(prepared.table, [ROW], v.TEST_SHARE, v.SEED)
    counted = watch.Watch()
    for name, frame in [("cleaned", prepared.table), ("train", learn), ("test", held_out)]:
        tables.write_table(counted.rows(frame, name), f"{folder}/{name}")
    for name, _, rows in counted.facts()[1:]:
        prepared.report.add("rows", name, rows)
    write_report(prepared.report.to_df(learn.sparkSession), f"{folder}/report")
    return learn, held_out


# ---- models -----------------------------------------------------------------

def model_columns(df: DataFrame, mode: str = "full", pruned: bool = False, label: str = v.PROFILE) -> train.Columns:
    """Feature columns of a mode, split into categorical and numeric."""
    names = columns.pick_features(df, [v.FEATURE_GROUPS[g] for g in v.FEATURE_MODES[mode]], v.BARRED_FEATURES, v.PRUNED_AWAY if pruned else ())
    categorical, numeric = columns.split_by_kind(df, names)
    return train.Columns(label, tuple(categorical), tuple(numeric), (ROW,))


def serving_stage() -> AssetFeatures:
    texts = [v.CATEGORY, v.MUNICIPALITY, v.PLACE_KIND, v.ZONE, v.SALE_TYPE]
    return AssetFeatures.build(v.OBJECT_AREA, v.LAND_AREA, v.PRICE, v.CATEGORY, texts, v.BUCKET_RULES)


SERVING_CATEGORICAL = (v.CATEGORY, v.MUNICIPALITY, v.PLACE_KIND, v.ZONE, v.SALE_TYPE, "asset_type_bucket_custom")
SERVING_NUMERIC = (
    v.OBJECT_AREA, v.LAND_AREA, v.PRICE, "total_area_m2_custom", "has_object_custom", "has_land_custom", "is_land_only_custom",
    "is_object_only_custom", "is_mixed_asset_custom", "object_to_land_ratio_custom", "price_per_total_m2_custom",
    "price_per_land_m2_custom", "price_per_object_m2_custom", "log_price_custom", "log_total_area_custom",
)
CATCH_ALL = "__OTHER__"


def fit_ranker(df: DataFrame, label: str, classifier) -> train.Fitted:
    """A classifier over serving-time features only."""
    return train.fit(serving_stage().transform(df), train.Columns(label, SERVING_CATEGORICAL, SERVING_NUMERIC, (ROW,)), classifier)


def rank_candidates(fitted: train.Fitted, assets: DataFrame, keys, k: int = 10, min_probability: float = 0.0, exclude_other: bool = False) -> DataFrame:
    """Top-k candidate labels per asset, with the catch-all probability told apart."""
    from pyspark.ml.functions import vector_to_array

    scored = fitted.score(serving_stage().transform(assets))
    return serve.top_candidates(
        scored, keys, vector_to_array("probability"), fitted.labels, k, min_probability, CATCH_ALL, exclude_other
    )
