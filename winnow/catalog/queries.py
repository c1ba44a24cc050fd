"""Queries over the test tables, one per operator or group of operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from winnow.catalog.fixture import ORDER, cooperatives, fact, growers, table, weighings
from winnow.functions.calendar import parse_date
from winnow.functions.conditional import clip
from winnow.functions.labels import canonical_key, strip_blanks, title_case
from winnow.functions.rounding import round_half_even
from winnow.operators.aggregates import distinct_pairs, keys_with_several, union_rows
from winnow.operators.anomalies import anomaly_summary, flag_anomalies
from winnow.operators.bounded import durable, shared_folder, small_or_same
from winnow.operators.canonical import (
    canonicalisation_stats,
    label_variants,
    official_collisions,
    official_labels,
    unknown_values,
    variant_sample,
)
from winnow.operators.dedup import dedup_summary, duplicate_counts
from winnow.operators.impute import imputation_summary, measured_only
from winnow.operators.joins import (
    attach_reference,
    duplicate_keys,
    hierarchy_counts,
    orphan_keys,
    orphan_label_count,
)
from winnow.operators.profile import (
    count_where,
    distribution,
    missing_rates,
    period_span,
    profile_columns,
)
from winnow.operators.quantiles import approx_quantiles, group_quantiles, medians_by_key
from winnow.operators.registry import KeyRegistry
from winnow.operators.rules import validate, verdict
from winnow.operators.sketches import distinct_sketches, merged_distincts, relative_error
from winnow.operators.spine import date_spine, weighted_spine
from winnow.operators.star import dimension
from winnow.plans import analyses, audit, cleaning, pipeline
from winnow.plans import weighings as w
from winnow.sources import schemas, tables
from winnow.sources.rejects import read_csv_with_rejects

Query = Callable[[SparkSession, str], DataFrame]

# Predicates over the weighings for rules that the plain fixture does not break.
_LOTS = "IF(prix_fcfa_kg % 5 = 0, concat('Lot ', prix_fcfa_kg % 60), qualite)"
_HOLES = "prix_fcfa_kg % 7 = 3"


def _text(df: DataFrame, *dates: str) -> DataFrame:
    """Dates as ISO text, which every client prints alike."""
    return df.withColumns({c: F.col(c).cast("string") for c in dates})


def _seasoned(spark: SparkSession, sf: str) -> DataFrame:
    """One row per ticket with season columns; labels as typed."""
    unique = cleaning.deduplicate(weighings(spark, sf), ORDER)
    return cleaning.season_columns(cleaning.correct_types(unique))


def _imputed(spark: SparkSession, sf: str) -> tuple[DataFrame, cleaning.CleaningStatistics]:
    rows = pipeline.stage_in()(_seasoned(spark, sf))
    stats = cleaning.cleaning_statistics(rows)
    return cleaning.impute(rows, stats), stats


def _measured(spark: SparkSession, sf: str) -> DataFrame:
    rows, stats = _imputed(spark, sf)
    return cleaning.derive_measures(rows, stats.grade_price)


def _clean(spark: SparkSession, sf: str) -> pipeline.Cleaned:
    return pipeline.clean(
        weighings(spark, sf), growers(spark, sf), cooperatives(spark, sf), ORDER, pipeline.stage_in()
    )


def _archived_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The fact as archived by the audit: written once, read by every check."""
    return pipeline.stage_in()(fact(spark, sf))


def _written(cleaned: pipeline.Cleaned) -> pipeline.Cleaned:
    """The clean fact as it is controlled: after it was written."""
    return replace(cleaned, fact=pipeline.stage_in()(cleaned.fact))


def flagship_weighted_price(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted mean price by grade and season of the cleaned weighings."""
    return analyses.weighted_price(_clean(spark, sf).fact)


def canonical_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.canonicalise_labels(weighings(spark, sf), cooperatives(spark, sf))
    return rows.select("id_pesee", "region", "cooperative")


def canonical_stats(spark: SparkSession, sf: str) -> DataFrame:
    return canonicalisation_stats(
        weighings(spark, sf),
        list(cleaning.TYPED_LABELS),
        cleaning.official_names(cooperatives(spark, sf)),
    )


def canonical_words(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical keys of every distinct word of the documents, with spellings and uses."""
    words = (
        table(spark, sf, "documents")
        .select(F.explode(F.split("text", r"[ \n\t\r]+")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
    return words.groupBy(canonical_key("word").alias("cle")).agg(
        F.count("*").alias("graphies"), F.sum("n").alias("emplois")
    )


def label_collisions(spark: SparkSession, sf: str) -> DataFrame:
    return official_collisions(weighings(spark, sf), "region")


def label_variant_counts(spark: SparkSession, sf: str) -> DataFrame:
    return label_variants(weighings(spark, sf), w.LABELS)


def label_variant_sample(spark: SparkSession, sf: str) -> DataFrame:
    return variant_sample(weighings(spark, sf), "region")


def label_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Stripped and title-cased form of every distinct typed label."""
    labels = weighings(spark, sf).select("region").distinct()
    return labels.select(
        "region", strip_blanks("region").alias("nettoye"), title_case("region").alias("titre")
    )


def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.deduplicate(weighings(spark, sf), ORDER).select(*w.FACT_COLUMNS)


def dedup_counts(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_counts(weighings(spark, sf), [w.KEY], w.FACT_COLUMNS)


def dedup_stats(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_summary(weighings(spark, sf), [w.KEY])


def calendar_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.season_columns(cleaning.correct_types(weighings(spark, sf)))
    return _text(rows, "date").select(
        "id_pesee", "date", "annee", "mois", "jour_semaine", "campagne", "saison"
    )


def enrich_left(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.attach_references(
        weighings(spark, sf), growers(spark, sf), cooperatives(spark, sf)
    )
    return rows.select(
        "id_pesee", "id_planteur", "cooperative", "superficie_ha", "annee_adhesion",
        "certifie_bio", "zone_production", "port_export",
    )


def reference_key_check(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(weighings(spark, sf), w.KEY)


def orphans_exact(spark: SparkSession, sf: str) -> DataFrame:
    return orphan_keys(
        weighings(spark, sf), "cooperative", cooperatives(spark, sf), "code_cooperative"
    )


def orphans_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return orphan_label_count(
        weighings(spark, sf), "cooperative", cooperatives(spark, sf), "code_cooperative", canonical_key
    )


def integrity_audit(spark: SparkSession, sf: str) -> DataFrame:
    parts = audit.audit_integrity(weighings(spark, sf), growers(spark, sf), cooperatives(spark, sf))
    report = None
    for key, part in parts.items():
        row = part.select(F.lit(key).alias("cle"), "orphelins")
        report = row if report is None else report.unionByName(row)
    return report


def hierarchy_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    return hierarchy_counts(weighings(spark, sf), "id_planteur", "region", growers(spark, sf))


def tonnage_class(spark: SparkSession, sf: str) -> DataFrame:
    return weighings(spark, sf).select(
        "id_pesee", "tonnage_kg", cleaning.weight_class().alias("categorie_tonnage")
    )


def export_flag(spark: SparkSession, sf: str) -> DataFrame:
    return weighings(spark, sf).select(
        "id_pesee", "humidite_pct", cleaning.export_flag().alias("conforme_export")
    )


def impute_price(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = _imputed(spark, sf)
    return rows.select("id_pesee", "qualite", "campagne", "prix_fcfa_kg", "prix_impute")


def impute_humidity(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = _imputed(spark, sf)
    return rows.select("id_pesee", "humidite_pct", "humidite_imputee", "conforme_export")


def impute_stats(spark: SparkSession, sf: str) -> DataFrame:
    return imputation_summary(_imputed(spark, sf)[0], list(w.IMPUTED_FLAGS))


def measures(spark: SparkSession, sf: str) -> DataFrame:
    return _measured(spark, sf).select(
        "id_pesee", "prix_fcfa_kg", "montant_fcfa", "ecart_prix_grade_pct"
    )


def profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile_columns(weighings(spark, sf), w.FACT_COLUMNS, ORDER)


def missing(spark: SparkSession, sf: str) -> DataFrame:
    return missing_rates(fact(spark, sf))


def distributions(spark: SparkSession, sf: str) -> DataFrame:
    rows = pipeline.stage_in()(weighings(spark, sf).select(*w.MEASURES))
    return distribution(rows, w.MEASURES)


def ranked_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Quartiles of a measure with many values, by the distributed ranking."""
    return group_quantiles(
        table(spark, sf, "lineitem"),
        ["l_returnflag"],
        "l_extendedprice",
        {"q1": 0.25, "mediane": 0.5, "q3": 0.75},
        local_rows=100,
    )


def grower_medians(spark: SparkSession, sf: str) -> DataFrame:
    """Median weight and price of every grower: many groups, one scan."""
    names = {"tonnage_median": "tonnage_kg", "prix_median": "prix_fcfa_kg"}
    return medians_by_key(weighings(spark, sf), "id_planteur", names)


def bracketed_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Quartiles of a measure with as many values as rows: every item priced by its own cent."""
    items = table(spark, sf, "lineitem")
    apart = F.col("l_extendedprice") * 1000 + F.col("l_orderkey") % 997 + F.col("l_linenumber") / 8
    wanted = {"q1": 0.25, "mediane": 0.5, "q3": 0.75, "q99": 0.99}
    found = group_quantiles(items, [], apart, wanted, local_rows=1000)
    return found.select(*[round_half_even(F.col(q), 3).alias(q) for q in wanted])


def sketched_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each sketched quartile has a rank within the stated accuracy of the wanted one."""
    rows, accuracy = table(spark, sf, "lineitem"), 1000
    wanted = {"q1": 0.25, "mediane": 0.5, "q3": 0.75}
    sketch = approx_quantiles(rows, ["l_returnflag"], "l_extendedprice", wanted, accuracy)
    value, size = F.col("l_extendedprice"), F.count("*")
    error = 1 / accuracy + 1 / size  # a wanted rank between two rows may fall on either
    return (
        rows.join(small_or_same(sketch), "l_returnflag")
        .groupBy("l_returnflag")
        .agg(
            *[
                (
                    (F.count_if(value < F.col(q)) / size <= p + error)
                    & (F.count_if(value <= F.col(q)) / size >= p - error)
                ).alias(f"{q}_juste")
                for q, p in wanted.items()
            ]
        )
    )


def period(spark: SparkSession, sf: str) -> DataFrame:
    return _text(period_span(weighings(spark, sf), parse_date(F.col("date"))), "debut", "fin")


def sentinel_count(spark: SparkSession, sf: str) -> DataFrame:
    return count_where(weighings(spark, sf), prix_aberrants=F.col("prix_fcfa_kg") <= 0)


def rules_report(spark: SparkSession, sf: str) -> DataFrame:
    """All rules on the raw table, where most of them fail."""
    return validate(_archived_fact(spark, sf), w.RULES, growers(spark, sf), cooperatives(spark, sf))


def rules_unknown_grades(spark: SparkSession, sf: str) -> DataFrame:
    """Rules where more grades are unknown than the message on regions would show."""
    lots = fact(spark, sf).withColumn("qualite", F.expr(_LOTS))
    return validate(lots, w.RULES, growers(spark, sf), cooperatives(spark, sf))


def rules_nan(spark: SparkSession, sf: str) -> DataFrame:
    """Rules where some weights and moistures are NaN: missing, not out of bounds."""
    holes = fact(spark, sf).withColumns(
        {c: F.when(F.expr(_HOLES), F.lit(float("nan"))).otherwise(F.col(c)) for c in ("tonnage_kg", "humidite_pct")}
    )
    return validate(holes, w.RULES, growers(spark, sf), cooperatives(spark, sf))


def rules_absent_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Rules on a table without regions and weights; the growers are still checked."""
    lacking = fact(spark, sf).drop("region", "tonnage_kg")
    return validate(lacking, w.RULES, growers(spark, sf), cooperatives(spark, sf))


def rules_clean(spark: SparkSession, sf: str) -> DataFrame:
    """All rules on the cleaned table."""
    cleaned = _written(_clean(spark, sf)).fact
    return validate(cleaned, w.RULES, growers(spark, sf), cooperatives(spark, sf))


def rules_verdict(spark: SparkSession, sf: str) -> DataFrame:
    rows = _archived_fact(spark, sf)
    checks = validate(rows, w.RULES, growers(spark, sf), cooperatives(spark, sf))
    return verdict(checks, rows.agg(F.count("*")).scalar())


def anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly_summary(fact(spark, sf))


def anomaly_rows(spark: SparkSession, sf: str) -> DataFrame:
    return flag_anomalies(fact(spark, sf)).select(
        "id_pesee", "tonnage_kg", "anomalie_tonnage", "anomalie_humidite", "anomalie_prix"
    )


def grade_summary(spark: SparkSession, sf: str) -> DataFrame:
    return analyses.grade_summary(fact(spark, sf))


def season_share(spark: SparkSession, sf: str) -> DataFrame:
    return analyses.season_share(fact(spark, sf))


def usable_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_pairs(
        analyses.usable_rows(fact(spark, sf), cooperatives(spark, sf)), "region", "cooperative"
    )


def multi_parent_keys(spark: SparkSession, sf: str) -> DataFrame:
    return keys_with_several(weighings(spark, sf), "cooperative", "region")


def hierarchy_check(spark: SparkSession, sf: str) -> DataFrame:
    return analyses.hierarchy_check(fact(spark, sf), growers(spark, sf), cooperatives(spark, sf))


def self_check(spark: SparkSession, sf: str) -> DataFrame:
    """The three self-checks of the raw tables as rows of one result."""
    parts = analyses.self_check(fact(spark, sf), growers(spark, sf), cooperatives(spark, sf))
    named = {
        "prix_par_grade": ("qualite", "nb", "prix_moyen", "humidite_moyenne"),
        "repartition_campagne": ("campagne", "nb_pesees", "tonnage_kg", "part_pct"),
        "hierarchie": (None, "lignes_exploitables", "couples", "planteurs_multi_region"),
    }
    report = None
    for name, (key, rows, first, second) in named.items():
        part = parts[name].select(
            F.lit(name).alias("controle"),
            (F.col(key) if key else F.lit("toutes")).alias("cle"),
            F.col(rows).cast("long").alias("nb"),
            F.col(first).cast("double").alias("premiere"),
            F.col(second).cast("double").alias("seconde"),
        )
        report = part if report is None else report.unionByName(part)
    return report


def reference_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the join with a reference is refused, by kind of reference."""
    every = growers(spark, sf)
    kinds = {
        "unique": every,
        "repetee": union_rows(every, F.col("superficie_ha") > 29),
        "cle manquante": every.withColumn("id_planteur", F.expr("IF(certifie_bio, NULL, id_planteur)")),
    }
    refused = {}
    for kind, reference in kinds.items():
        try:
            attach_reference(weighings(spark, sf), reference, "id_planteur", ["superficie_ha"])
            refused[kind] = False
        except ValueError:
            refused[kind] = True
    return spark.createDataFrame(sorted(refused.items()), "reference string, refusee boolean")


def tolerant_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates in the imposed format, NULL for texts in another one."""
    rows = weighings(spark, sf)
    text = F.expr(
        "CASE l_partkey % 9 WHEN 0 THEN replace(date, '-', '/') WHEN 1 THEN concat(substr(date, 1, 5), '13-01')"
        " WHEN 2 THEN '' ELSE date END"
    )
    day = parse_date(text, strict=False)
    return _text(rows.select("id_pesee", text.alias("texte"), day.alias("jour")), "jour")


def tonnage_class_text(spark: SparkSession, sf: str) -> DataFrame:
    """Weight classes with a text where there is no class."""
    rows = weighings(spark, sf).withColumn("tonnage_kg", F.expr("IF(prix_fcfa_kg % 7 = 3, NULL, tonnage_kg)"))
    return rows.select("id_pesee", cleaning.weight_class("nan").alias("categorie_tonnage"))


def label_order(spark: SparkSession, sf: str) -> DataFrame:
    """Official label of each key, the last to appear in descending order of the suppliers."""
    spelled = F.expr("IF(code_cooperative LIKE '%1', lower(region), region)")
    place = F.regexp_extract("code_cooperative", "([0-9]+)$", 1).cast("long")
    reference = cooperatives(spark, sf).select(spelled.alias("region"), (-place).alias("position"))
    found = official_labels(reference, {"region": "region"}, "position")
    return found.select("label_key", "official")


def unknown_regions(spark: SparkSession, sf: str) -> DataFrame:
    return unknown_values(weighings(spark, sf), "region", cooperatives(spark, sf))


def tiered_price(spark: SparkSession, sf: str) -> DataFrame:
    """Price formula with its tiers, on the raw price and the grower's certificate."""
    rows = cleaning.season_columns(
        cleaning.attach_references(
            cleaning.correct_types(weighings(spark, sf)), growers(spark, sf), cooperatives(spark, sf)
        )
    )
    price = analyses.tiered_price(
        F.col("prix_fcfa_kg"),
        F.col("certifie_bio"),
        F.col("campagne") == w.MAIN_SEASON,
        F.col("tonnage_kg"),
    )
    return rows.select("id_pesee", "prix_fcfa_kg", price.alias("prix_ajuste"))


def clip_values(spark: SparkSession, sf: str) -> DataFrame:
    return weighings(spark, sf).select(
        "id_pesee",
        clip(F.col("humidite_pct"), 6.0, 9.0).alias("humidite_bornee"),
        clip(F.col("tonnage_kg"), low=100.0).alias("tonnage_plancher"),
    )


def date_spine_weights(spark: SparkSession, sf: str) -> DataFrame:
    spine = date_spine(weighings(spark, sf), parse_date(F.col("date")))
    weighted = weighted_spine(spine, w.MONTH_WEIGHTS, w.SUNDAY_FACTOR)
    return _text(weighted.withColumn("poids", round_half_even(F.col("poids"), 9)), "jour")


def union_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    rows = weighings(spark, sf, copies=False)
    doubled = union_rows(rows, F.split("id_pesee", "-")[0].cast("long") % 67 == 0)
    return doubled.select(*w.FACT_COLUMNS).orderBy("date", "id_pesee")


def preview(spark: SparkSession, sf: str) -> DataFrame:
    """First five rows of the clean fact in date order."""
    rows = _clean(spark, sf).fact.select("id_pesee", "date", "qualite", "tonnage_kg", "prix_fcfa_kg")
    return _text(rows.orderBy("date", "id_pesee").limit(5), "date")


def compliance_by_month(spark: SparkSession, sf: str) -> DataFrame:
    return analyses.compliance_by_month(_imputed(spark, sf)[0])


def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    rows = weighings(spark, sf).withColumn("categorie_tonnage", cleaning.weight_class())
    return analyses.class_distribution(rows)


def measured_weighted_price(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted price by grade without the imputed prices."""
    return analyses.weighted_price(measured_only(_measured(spark, sf), ["prix_impute"]), ("qualite",))


def star_dimension(spark: SparkSession, sf: str) -> DataFrame:
    attributes = ["superficie_ha", "annee_adhesion", "certifie_bio"]
    return dimension(growers(spark, sf), "id_planteur", "cle_planteur", attributes)


def star_fact(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = _clean(spark, sf).fact
    star = analyses.star_schema(cleaned, growers(spark, sf), cooperatives(spark, sf))
    return star["fact"].select(
        "id_region", "id_cooperative", "cle_planteur", "id_pesee", "montant_fcfa"
    )


def clean_fact(spark: SparkSession, sf: str) -> DataFrame:
    return _text(_clean(spark, sf).fact, "date")


def season_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return analyses.season_comparison(_seasoned(spark, sf))


def season_comparison_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """The same where most months of every second year had no delivery."""
    rows = _seasoned(spark, sf).filter("annee % 2 = 0 OR mois IN (2, 11)")
    return analyses.season_comparison(rows)


def stable_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Grower keys after two loads: the second brings new growers and lacks some old ones."""
    path = f"{shared_folder(spark)}/registry-{uuid4().hex}"
    registry = KeyRegistry(spark, path, "id_planteur", "cle_planteur")
    every = growers(spark, sf)
    registry.load(every.filter("NOT certifie_bio"))
    registry.load(every.filter("superficie_ha >= 2"))
    registry.load(every.filter("superficie_ha >= 2"))
    return registry.dimension(every.filter("superficie_ha >= 2"), ["region", "superficie_ha"])


def sketched_distincts(spark: SparkSession, sf: str) -> DataFrame:
    """Whether merged sketches of a stage partitioned by grade estimate distinct values rightly."""
    columns = ["id_pesee", "id_planteur", "prix_fcfa_kg", "tonnage_kg"]
    rows = pipeline.stage_in()(fact(spark, sf))
    sketches = durable(distinct_sketches(rows, ["qualite"], columns))
    every = [F.struct(F.lit(c).alias("colonne"), F.col(c).cast("string").alias("v")) for c in columns]
    values = rows.select("qualite", F.inline(F.array(*every))).dropna().distinct()
    several = F.col("qualite") != "Grade A"
    subsets = {"chaque": F.lit(True), "toutes": F.lit(True), "sans A": several}
    report = None
    for name, chosen in subsets.items():
        keys = ["qualite"] if name == "chaque" else []
        exact = values.filter(chosen).select(*keys, "colonne", "v").distinct()
        exact = exact.groupBy(*keys, "colonne").agg(F.count("*").alias("exact"))
        found = merged_distincts(sketches.filter(chosen), keys).join(exact, [*keys, "colonne"])
        right = F.abs(F.col("distincts") / F.col("exact") - 1) <= relative_error()
        part = found.select(
            (F.col("qualite") if keys else F.lit(name)).alias("partie"), "colonne", right.alias("juste")
        )
        report = part if report is None else report.unionByName(part)
    return report


def bucketed_first(spark: SparkSession, sf: str) -> DataFrame:
    """Keep-first on a stage in buckets of the ticket, without an exchange."""
    name = f"stage_{uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = tables.write_bucketed(weighings(spark, sf), name, path, w.KEY, ORDER, buckets)
    return cleaning.deduplicate(rows, ORDER).select(*w.FACT_COLUMNS)


_LINE = """concat_ws(',', id_pesee, IF(l_partkey % 109 = 11, '31/02/2020', date), region,
    concat('"', cooperative, '"'), id_planteur, IF(l_partkey % 107 = 7, 'lourd', CAST(tonnage_kg AS STRING)), qualite)"""


def _rejecting(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The weighings as CSV lines with short, surplus and unreadable cells, read tolerantly."""
    path = f"{shared_folder(spark)}/lines-{uuid4().hex}"
    rest = "concat(',', prix_fcfa_kg, ',', coalesce(CAST(humidite_pct AS STRING), ''))"
    end = f"CASE WHEN l_partkey % 101 = 3 THEN concat({rest}, ',x') WHEN l_partkey % 103 = 5 THEN '' ELSE {rest} END"
    weighings(spark, sf).selectExpr(f"concat({_LINE}, {end}) AS value").write.text(path)
    return read_csv_with_rejects(
        spark, path, schemas.WEIGHINGS, w.KEY, missing=("",), dates={"date": "yyyy-MM-dd"}, header=False
    )


def csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Everything that was wrong with the CSV lines."""
    _, rejects = _rejecting(spark, sf)
    return rejects.select(
        "id_pesee", "colonne", "raison", F.when(F.col("colonne").isNotNull(), F.col("texte")).alias("texte")
    )


def csv_rejects_kept(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that tolerant reading keeps, short ones filled."""
    return _rejecting(spark, sf)[0].select(*w.FACT_COLUMNS)


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The fact written as CSV and read back under its declared schema."""
    path = f"{shared_folder(spark)}/csv-{uuid4().hex}"
    return tables.read_csv(
        spark, tables.write_csv(fact(spark, sf), path), schemas.WEIGHINGS, missing=("",)
    )


def stage_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The fact written as a Parquet stage, partitioned by grade, and read back."""
    path = f"{shared_folder(spark)}/stage-{uuid4().hex}"
    written = tables.write_stage(fact(spark, sf), path, ["qualite"])
    return tables.read_stage(spark, written).select(*w.FACT_COLUMNS)


def csv_text_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Document texts with line breaks, quotes and backslashes, written as CSV and read back."""
    path = f"{shared_folder(spark)}/csv-{uuid4().hex}"
    awkward = F.concat(F.lit('"a""b" \\ '), "text", F.lit(', \\n"\n"'))
    written = tables.write_csv(table(spark, sf, "documents").select("doc_id", awkward.alias("text")), path)
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])
    return tables.read_csv(spark, written, schema, multiline=True)


def _audit_report(spark: SparkSession, sf: str) -> DataFrame:
    stage = pipeline.stage_in()
    return audit.audit_report(
        {
            "pesees": stage(weighings(spark, sf)),
            "planteurs": growers(spark, sf),
            "cooperatives": cooperatives(spark, sf),
        },
        {"pesees": "lineitem", "planteurs": "customer", "cooperatives": "supplier"},
        {"pesees": stage.rows},
        generated=False,
    )


def audit_json(spark: SparkSession, sf: str) -> DataFrame:
    """The audit report as JSON text."""
    return _audit_report(spark, sf).select(F.to_json(F.struct("*")).alias("rapport"))


def _entries(*parts: tuple[str, Column]) -> Column:
    """Named values of a report as an array of path and text."""
    return F.array(*[F.struct(F.lit(p).alias("chemin"), v.cast("string").alias("valeur")) for p, v in parts])


def _fields(report: DataFrame, path: str) -> Column:
    """The fields of a nested struct of a report by their paths."""
    names = report.select(f"{path}.*").columns
    return _entries(*[(f"{path}.{n}", F.col(f"{path}.{n}")) for n in names])


def _keyed(path: str) -> Column:
    """The entries of a map of a report by their paths."""
    return F.transform(
        F.map_entries(path),
        lambda e: F.struct(
            F.concat(F.lit(f"{path}."), e["key"]).alias("chemin"), e["value"].cast("string").alias("valeur")
        ),
    )


def _listed(path: str, text: Callable[[Column], Column] = lambda row: row) -> Column:
    """The elements of a list of a report by their places from 0."""
    return F.transform(
        path,
        lambda row, i: F.struct(
            F.concat(F.lit(f"{path}."), i.cast("string")).alias("chemin"), text(row).alias("valeur")
        ),
    )


def _amount(value: Column) -> Column:
    return value.cast("decimal(20,2)").cast("string")


def audit_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The audit report as one row per entry, ``chemin`` and ``valeur``."""
    report = _audit_report(spark, sf)
    single = ("doublons_id_pesee", "doublons_lignes_completes", "prix_aberrants")
    parts = [_fields(report, f"sources.{name}") for name in ("pesees", "planteurs", "cooperatives")]
    parts.append(_entries(*[(f"constats.{n}", F.col(f"constats.{n}")) for n in single]))
    parts += [_keyed(f"constats.{n}") for n in ("valeurs_manquantes", "variantes_saisie")]
    parts += [_fields(report, f"constats.{n}") for n in ("periode", "integrite")]
    return report.select(F.inline(F.concat(*parts)))


def _quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.quality_report(
        _written(_clean(spark, sf)),
        growers(spark, sf),
        cooperatives(spark, sf),
        generated=False,
    )


def quality_json(spark: SparkSession, sf: str) -> DataFrame:
    """The quality report as JSON text."""
    return _quality_report(spark, sf).select(F.to_json(F.struct("*")).alias("rapport"))


def quality_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The quality report as one row per entry, ``chemin`` and ``valeur``."""
    report = _quality_report(spark, sf)
    structs = ("volumes", "normalisation_libelles.region", "normalisation_libelles.cooperative",
               "dedoublonnage", "imputation")
    lists = ("controles_passes", "erreurs", "avertissements")
    return report.select(
        F.inline(
            F.concat(
                *[_fields(report, path) for path in structs],
                _entries(*[(f"validation.{n}", F.col(f"validation.{n}")) for n in ("valide", "nb_lignes")]),
                *[_listed(f"validation.{n}") for n in lists],
                _listed(
                    "anomalies",
                    lambda r: F.concat_ws(
                        "|", r["anomalie"], r["critere"], r["nb_lignes"].cast("string"),
                        _amount(r["part_pct"]), _amount(r["tonnage_concerne_kg"]), r["action"],
                    ),
                ),
                _listed(
                    "valeurs_manquantes_restantes",
                    lambda r: F.concat_ws(
                        "|", r["colonne"], r["nb_manquants"].cast("string"), _amount(r["part_pct"])
                    ),
                ),
            )
        )
    )


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        flagship_weighted_price, canonical_labels, canonical_stats, canonical_words,
        label_collisions, label_variant_counts, label_variant_sample, label_forms, dedup_first,
        dedup_counts, dedup_stats, calendar_columns, enrich_left, reference_key_check,
        orphans_exact, orphans_canonical, integrity_audit, hierarchy_mismatch, tonnage_class,
        export_flag, impute_price, impute_humidity, impute_stats, measures, profile, missing,
        distributions, ranked_quantiles, bracketed_quantiles, grower_medians, sketched_quantiles, period,
        sentinel_count, rules_report, rules_clean, rules_verdict, anomalies, anomaly_rows,
        grade_summary, season_share, usable_pairs, multi_parent_keys, hierarchy_check,
        unknown_regions, tiered_price, clip_values, date_spine_weights, union_duplicates, preview,
        compliance_by_month, class_distribution, measured_weighted_price, star_dimension,
        star_fact, clean_fact, csv_round_trip, stage_round_trip, audit_json, quality_json,
        audit_rows, quality_rows, rules_unknown_grades, rules_nan, rules_absent_columns,
        csv_text_round_trip, season_comparison, season_comparison_gaps, stable_keys,
        sketched_distincts, bucketed_first, csv_rejects, csv_rejects_kept, self_check,
        reference_guard, tolerant_dates, tonnage_class_text, label_order,
    )
}
