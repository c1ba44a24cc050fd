"""Read-only audit of the raw tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from winnow.functions.calendar import parse_date
from winnow.functions.labels import canonical_key
from winnow.operators.canonical import label_variants, variant_sample
from winnow.operators.dedup import duplicate_counts
from winnow.operators.joins import orphan_count, orphan_label_count
from winnow.operators.measured import Wanted, measure_table
from winnow.operators.profile import (
    count_where,
    distribution,
    missing_rates,
    period_span,
    profile_columns,
)
from winnow.plans import weighings as w
from winnow.sources.stages import Run
from winnow.sources.tables import read_stage, write_report, write_stage


def _measurements(
    fact: DataFrame, order: Sequence[str]
) -> dict[str, Callable[[], DataFrame]]:
    columns = [c for c in w.FACT_COLUMNS if c in fact.columns]
    return {
        "types": lambda: profile_columns(fact, columns, order),
        "valeurs_manquantes": lambda: missing_rates(fact, columns),
        "doublons": lambda: duplicate_counts(fact, [w.KEY], columns),
        "libelles": lambda: label_variants(fact, w.LABELS),
        "exemples_variantes": lambda: variant_sample(fact, "region"),
        "distribution": lambda: distribution(fact, w.MEASURES),
        "prix_aberrants": lambda: count_where(fact, nb=F.col("prix_fcfa_kg") <= 0),
        "periode": lambda: period_span(fact, parse_date(F.col("date"))),
    }


def audit_fact(
    fact: DataFrame, order: Sequence[str], names: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """The named measurements of the fact table, all by default, as one small table each."""
    every = _measurements(fact, order)
    return {name: every[name]() for name in names or every}


def audit_integrity(
    fact: DataFrame, growers: DataFrame, cooperatives: DataFrame
) -> dict[str, DataFrame]:
    """Orphan rows per key; labels are compared by canonical key, so variants are none."""

    def labels(column: str, reference_column: str) -> DataFrame:
        return orphan_label_count(fact, column, cooperatives, reference_column, canonical_key)

    return {
        "id_planteur": orphan_count(fact, "id_planteur", growers, "id_planteur"),
        "cooperative": labels("cooperative", "code_cooperative"),
        "region": labels("region", "region"),
    }


def measurements(
    fact: DataFrame, growers: DataFrame, cooperatives: DataFrame
) -> DataFrame:
    """All figures of the audit report as one row, from one scan of the fact."""
    return measure_table(
        fact,
        Wanted(
            w.KEY,
            [c for c in w.FACT_COLUMNS if c in fact.columns],
            labels=w.LABELS,
            references={
                "id_planteur": (growers, "id_planteur"),
                "cooperative": (cooperatives, "code_cooperative"),
                "region": (cooperatives, "region"),
            },
            conditions={"prix_aberrants": "prix_fcfa_kg <= 0"},
            date="date",
            parse=parse_date,
        ),
    )


def one_row(table: DataFrame) -> Column:
    """A one-row table as a struct; equal subqueries of a report run once."""
    return table.select(F.struct("*")).scalar()


def as_map(table: DataFrame, key: str, value: Column | str) -> Column:
    """A table with a row per column of the fact as one map, in key order."""
    entry = F.struct(F.col(key), F.col(value) if isinstance(value, str) else value)
    return table.agg(F.map_from_entries(F.array_sort(F.collect_list(entry)))).scalar()


def audit_report(
    tables: Mapping[str, DataFrame],
    files: Mapping[str, str],
    rows: Mapping[str, int] | None = None,
    generated: bool = True,
) -> DataFrame:
    """The audit as one nested row, ready to be written as JSON.

    ``rows`` are known sizes of the tables; only a reference without one is counted.
    """
    rows = rows or {}
    fact, growers, cooperatives = (tables[t] for t in ("pesees", "planteurs", "cooperatives"))

    def size(name: str) -> Column:
        if name in rows:
            return F.lit(rows[name]).cast("long")
        return F.col("lignes") if name == "pesees" else tables[name].agg(F.count("*")).scalar()

    sources = [
        F.struct(F.lit(files[n]).alias("fichier"), size(n).alias("nb_lignes")).alias(n) for n in tables
    ]
    variants = [(c, F.col(f"brutes_{c}") - F.col(f"normalisees_{c}")) for c in sorted(w.LABELS)]
    findings = F.struct(
        F.col("manquants").alias("valeurs_manquantes"),
        F.col("doublons_cle").alias("doublons_id_pesee"),
        F.col("doublons_complets").alias("doublons_lignes_completes"),
        F.create_map(*[x for c, n in variants for x in (F.lit(c), n)]).alias("variantes_saisie"),
        F.col("prix_aberrants"),
        F.struct(*[F.col(c).cast("string").alias(c) for c in ("debut", "fin")]).alias("periode"),
        F.struct(
            F.col("orphelins_id_planteur").alias("orphelins_planteur"),
            F.col("orphelins_cooperative"),
            F.col("orphelins_region"),
        ).alias("integrite"),
    )
    report = measurements(fact, growers, cooperatives).select(
        F.struct(*sources).alias("sources"), findings.alias("constats")
    )
    return stamped(report) if generated else report


def run(
    tables: Mapping[str, DataFrame], files: Mapping[str, str], output: str
) -> dict[str, DataFrame]:
    """Archive the raw tables, audit the archived rows, write the report, return the tables.

    The sources are read once, and counted as they are written; one scan of the archive gives
    every measurement. The archives and the report appear together, when all are complete.
    """
    spark = next(iter(tables.values())).sparkSession
    paths = {name: f"{output}/brut_{name}.parquet" for name in tables}
    rows = {}
    with Run(spark) as run:
        for name, table in tables.items():
            seen = Observation()
            write_stage(table.observe(seen, F.count(F.lit(1)).alias("n")), run.result(paths[name]))
            rows[name] = seen.get["n"]
        written = {name: read_stage(spark, run.pending[path]) for name, path in paths.items()}
        report = f"{output}/rapport_audit.json"
        write_report(audit_report(written, files, rows), run.result(report))
    return {name: read_stage(spark, path) for name, path in paths.items()}


def stamped(report: DataFrame) -> DataFrame:
    """The report with its time of generation in front."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return report.select(now.alias("genere_le"), "*")
