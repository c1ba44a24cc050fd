"""Validation rules: every problem is reported as a row, none raises.

A fact row becomes a few rows of (code, key, attribute): its faults, its ticket, its labels,
its grower with the region. One scan counts them, so hot keys and labels are folded before the
only exchange; one join with the stacked reference keys and one aggregate decide every rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.functions.nulls import nan_to_null
from winnow.operators.bounded import LOCAL_ROWS, durable, local_if_small

# Levels and report texts (failed, passed) of the checks.
OK, WARNING, ERROR = "OK", "AVERTISSEMENT", "ERREUR"
TEXTS = {
    "volume": (
        "R1 volume : %s lignes, en dessous du seuil de %s. Extraction probablement incomplete.",
        "R1 volume : %s lignes (seuil %s)",
    ),
    "unicite": (
        "R2 unicite : %s doublon(s) sur %s. Le dedoublonnage n'a pas ete applique.",
        "R2 unicite : aucun doublon sur %2$s",
    ),
    "absente": ("%s : colonne absente '%s'", ""),
    "completude": (
        "R3 completude : valeurs manquantes sur %s",
        "R3 completude : %2$s colonnes critiques sans valeur manquante",
    ),
    "grades": (
        "R4 domaine : grade(s) inconnu(s) %s. Attendus : %s",
        "R4 domaine : tous les grades appartiennent au referentiel",
    ),
    "regions": (
        "R4 domaine : region(s) non normalisee(s) %s",
        "R4 domaine : %2$s regions, toutes normalisees",
    ),
    "bornes": (
        "R5 bornes : %s",
        "R5 bornes : tonnage, prix et humidite dans les plages metier",
    ),
    "planteurs": (
        "R6 integrite : %s pesee(s) referencent un planteur absent du referentiel",
        "R6 integrite : tous les planteurs existent au referentiel",
    ),
    "cooperatives": (
        "R6 integrite : %s pesee(s) referencent une cooperative inconnue",
        "R6 integrite : toutes les cooperatives existent au referentiel",
    ),
    "coherence": (
        "R7 coherence : %s pesee(s) dont la region differe de celle du planteur au referentiel",
        "R7 coherence : region de la pesee identique a celle du planteur",
    ),
    "impute": (
        "%s %% des lignes ont une valeur de %s imputee, prudence dans l'interpretation",
        "",
    ),
}


@dataclass(frozen=True)
class RuleSet:
    """Columns, domains and thresholds of the rules.

    The message on grades lists every unknown grade; the one on regions the first
    ``regions_shown`` unknown regions in order of the label, while ``nb`` counts all.
    """

    key: str
    critical: Sequence[str]
    grade: str
    grades: Sequence[str]
    region: str
    cooperative: str
    reference_cooperative: str
    grower: str
    bounds: Mapping[str, tuple[float, float]]
    imputed: Mapping[str, str]
    minimum_rows: int = 70_000
    imputed_limit_pct: float = 5.0
    regions_shown: int = 5


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(column: str) -> str:
    """A column name as SQL, whatever it contains."""
    return "`" + column.replace("`", "``") + "`"


def _number(value: str) -> str:
    return f"format_number({value}, 0)"


def _check(
    order: int, rule: str, name: str, text: str, bad: str, *values: str, level: str = ERROR
) -> str:
    """SQL struct of one check, failed when ``bad`` is positive; ``values`` fill its text."""
    failed, passed = (f"format_string({', '.join((_quoted(t), *values))})" for t in TEXTS[text])
    return f"""named_struct('ordre', {order}, 'regle', '{rule}', 'controle', {_quoted(name)},
        'niveau', IF({bad} > 0, '{level}', '{OK}'), 'nb', CAST({bad} AS BIGINT),
        'message', IF({bad} > 0, {failed}, {passed}))"""


def _as_rows(totals: DataFrame, checks: Sequence[str]) -> DataFrame:
    return totals.selectExpr(f"inline(array({', '.join(checks)}))")


def _listing(counts: Mapping[str, str], suffix: Mapping[str, str] | None = None) -> str:
    """``'a (3), b (1)'`` for the columns with a positive count."""
    texts = [
        f"IF({n} > 0, concat({_quoted(c + ' (')}, {_number(n)},"
        f" {_quoted((suffix or {}).get(c, '') + ')')}), NULL)"
        for c, n in counts.items()
    ]
    return f"concat_ws({', '.join((_quoted(', '), *texts))})"


def _total(counts: Mapping[str, str]) -> str:
    return f"({' + '.join(('0L', *counts.values()))})"


# Codes of the stacked rows. A fact row gives one row of each code that applies.
_FAULTS, _KEY, _GRADE, _REGION, _COOPERATIVE, _GROWER = range(6)


def _faults(df: DataFrame, rules: RuleSet) -> dict[str, dict[str, str]]:
    """Conditions of the row-local checks by family and column, for the columns at hand."""
    of = {
        "missing": {c: f"{_name(c)} IS NULL" for c in rules.critical},
        "outside": {
            c: f"{_name(c)} < {low}D OR {_name(c)} > {high}D"
            for c, (low, high) in rules.bounds.items()
        },
        "imputed": {c: _name(c) for c in rules.imputed},
    }
    return {f: {c: x for c, x in cs.items() if c in df.columns} for f, cs in of.items()}


def _entry(code: int, key: str, attribute: str = "NULL", amount: str = "") -> str:
    return (
        f"named_struct('code', {code}, 'k', CAST({key} AS STRING),"
        f" 'a', CAST({attribute} AS STRING){amount})"
    )


def _stacked_counts(
    df: DataFrame, faults: Sequence[str], rules: RuleSet, checked: Mapping[int, str], amount: str | None
) -> DataFrame:
    """``(kind, k, a, n, extra)``: rows per code, key and attribute, from one scan and exchange.

    The faults of a row are one text of 0 and 1, of which a table has few; the sum ``w`` of an
    amount goes with them. Everything is counted before the exchange, so a hot key or label
    sends one row per task; only the distinct keys of the table travel. ``extra`` are the
    repeated rows of a key.
    """
    marks = ", ".join(["''", *[f"IF({x}, '1', '0')" for x in faults]])
    own, none = (f", 'w', CAST({x} AS DOUBLE)" if amount else "" for x in (amount, "NULL"))
    entries = [_entry(_FAULTS, f"concat({marks})", amount=own)]
    for code, column in checked.items():
        region = _name(rules.region) if code == _GROWER and rules.region in df.columns else "NULL"
        entries.append(_entry(code, _name(column), region, none))
    stacked = df.selectExpr(f"inline(array({', '.join(entries)}))")
    # ``kind`` repeats the code as a result, so that no filter on it reaches below the exchange
    # and all readers of the counts share it.
    return (
        stacked.groupBy("code", "k", "a")
        .agg(
            F.count("*").alias("n"),
            F.max("code").alias("kind"),
            *([F.sum("w").alias("w")] if amount else []),
        )
        .withColumn("extra", F.col("n") - 1)
        .drop("code")
    )


def _reference_rows(
    spark: SparkSession,
    rules: RuleSet,
    growers: DataFrame | None,
    cooperatives: DataFrame | None,
) -> DataFrame:
    """``(r_kind, r_k, low, high)``: the known keys of all domains with their attribute's extremes."""
    rows = spark.createDataFrame([(_GRADE, g, None) for g in rules.grades], "code int, k string, a string")
    if cooperatives is not None:
        of = (_entry(_REGION, _name(rules.region)), _entry(_COOPERATIVE, _name(rules.reference_cooperative)))
        rows = rows.unionByName(cooperatives.selectExpr(f"inline(array({', '.join(of)}))"))
    if growers is not None:
        region = _name(rules.region) if rules.region in growers.columns else "NULL"
        entry = _entry(_GROWER, _name(rules.grower), region)
        rows = rows.unionByName(growers.selectExpr(f"inline(array({entry}))"))
    return (
        rows.filter("k IS NOT NULL")
        .groupBy(F.col("code").alias("r_kind"), F.col("k").alias("r_k"))
        .agg(F.min("a").alias("low"), F.max("a").alias("high"))
    )


def _against_references(counts: DataFrame, references: DataFrame, local_rows: int) -> DataFrame:
    """The counted keys with their reference, from one join of all domains.

    References that are proven small are broadcast. Otherwise the ticket keys, which no
    reference knows, are first added up within each partition, so that only labels and
    growers move again; these are kept, as the figures and the listing both read them.
    """
    small = local_if_small(references, local_rows)
    if small is None:
        own = F.col("kind").isin(_FAULTS, _KEY)
        key = F.when(~(F.col("kind") == _KEY), F.col("k")).alias("k")
        sums = [c for c in ("n", "extra", "w") if c in counts.columns]
        counts = durable(counts.groupBy("kind", key, "a").agg(*[F.sum(c).alias(c) for c in sums]))
        known, rest = references, counts.withColumn("j", F.when(~own, F.col("k")))
        joined = rest.join(known, F.expr("kind = r_kind AND j = r_k"), "left").drop("j")
    else:
        joined = counts.join(F.broadcast(small), F.expr("kind = r_kind AND k = r_k"), "left")
    return joined


def _listed(found: str) -> str:
    return f"""concat("['", array_join({found}.k, "', '"), "']")"""


def _measured(joined: DataFrame, faults: Sequence[str], rules: RuleSet) -> DataFrame:
    """One row with every figure of the checks; the count of each fault has its name."""
    sums = []
    for place, fault in enumerate(faults, 1):
        marked = f"kind = {_FAULTS} AND substring(k, {place}, 1) = '1'"
        sums.append(_sum(marked, "n", fault))
        if "w" in joined.columns:
            sums.append(F.expr(f"coalesce(sum(IF({marked}, w, 0D)), 0D) AS amount_{fault}"))
    unknown = "k IS NOT NULL AND r_k IS NULL"
    expected = "IF(low = high, low, NULL)"
    listing = f"collect_list(IF(kind = {_GRADE} AND {unknown}, struct(k, n), NULL))"
    totals = joined.agg(
        *sums,
        _sum(f"kind = {_FAULTS}", "n", "rows"),
        _sum(f"kind = {_KEY}", "extra", "repeated"),
        _sum(f"kind = {_GRADE} AND {unknown}", "1L", "grades"),
        _sum(f"kind = {_REGION} AND {unknown}", "1L", "regions"),
        _sum(f"kind = {_REGION} AND k IS NOT NULL", "1L", "labels"),
        _sum(f"kind = {_COOPERATIVE} AND r_k IS NULL", "n", "cooperatives"),
        _sum(f"kind = {_GROWER} AND r_k IS NULL", "n", "orphans"),
        _sum(f"kind = {_GROWER} AND NOT coalesce(a = {expected}, false)", "n", "incoherent"),
        F.expr(f"array_sort({listing}) AS grades_found"),
    )
    # Tied to ``kind`` the condition on the key stays above the exchange as well; ``w`` is NULL
    # here, but as it is read no result of the counts is pruned and their exchange is shared.
    first = (
        joined.filter(f"IF(kind = {_REGION} AND r_k IS NULL, k, NULL) IS NOT NULL")
        .orderBy("k", *([F.col("w")] if "w" in joined.columns else []))
        .limit(rules.regions_shown)
        .agg(F.expr("array_sort(collect_list(struct(k, n)))"))
    )
    return totals.withColumn("regions_found", first.scalar())


def _sum(condition: str, value: str, name: str) -> Column:
    return F.expr(f"coalesce(sum(IF({condition}, {value}, 0L)), 0L) AS {name}")


def _local_checks(rules: RuleSet, names: Mapping[str, Mapping[str, str]]) -> list[str]:
    """R1, R3, R5 and the imputation warnings."""
    missing, outside, imputed = (names[f] for f in ("missing", "outside", "imputed"))
    ranges = {c: f" hors [{rules.bounds[c][0]:g} ; {rules.bounds[c][1]:g}]" for c in outside}
    minimum = f"{rules.minimum_rows}L"
    checks = [
        _check(
            1, "R1", "volume", "volume", f"greatest({minimum} - rows, 0L)",
            _number("rows"), _number(minimum),
        ),
        _check(
            4, "R3", "completude", "completude", _total(missing),
            _listing(missing), f"'{len(missing)}'",
        ),
        _check(7, "R5", "bornes", "bornes", _total(outside), _listing(outside, ranges)),
    ]
    checks += [
        _check(3, "R3", c, "absente", "1", "'R3 completude'", _quoted(c))
        for c in rules.critical
        if c not in missing
    ]
    for column, count in imputed.items():
        share = f"try_divide({count}, rows) * 100"
        many = f"IF({share} > {rules.imputed_limit_pct}D, {count}, 0L)"
        text = f"format_string('%.1f', rint({share} * 10) / 10)"
        checks.append(
            _check(
                11, "V1", column, "impute", many, text, _quoted(rules.imputed[column]), level=WARNING
            )
        )
    return checks


def _key_checks(rules: RuleSet, checked: Mapping[int, str], region: bool) -> list[str]:
    """R2, R4, R6 and R7 of the columns at hand."""
    grades = _quoted("[" + ", ".join(f"'{g}'" for g in sorted(rules.grades)) + "]")
    of = {
        _KEY: [_check(2, "R2", "unicite", "unicite", "repeated", _number("repeated"), _quoted(rules.key))],
        _GRADE: [_check(5, "R4", rules.grade, "grades", "grades", _listed("grades_found"), grades)],
        _REGION: [
            _check(
                6, "R4", rules.region, "regions", "regions", _listed("regions_found"),
                "CAST(labels AS STRING)",
            )
        ],
        _COOPERATIVE: [
            _check(9, "R6", rules.cooperative, "cooperatives", "cooperatives", _number("cooperatives"))
        ],
        _GROWER: [_check(8, "R6", rules.grower, "planteurs", "orphans", _number("orphans"))],
    }
    if region:
        of[_GROWER].append(
            _check(10, "R7", "coherence", "coherence", "incoherent", _number("incoherent"))
        )
    return [check for code in checked for check in of[code]]


def _absent_columns(df: DataFrame, absent: Sequence[tuple[int, str, str]]) -> DataFrame:
    """Error rows for rules whose column the table does not have."""
    rows = [
        (order, rule, column, ERROR, 1, TEXTS["absente"][0] % (rule, column))
        for order, rule, column in absent
    ]
    return df.sparkSession.createDataFrame(
        rows, "ordre int, regle string, controle string, niveau string, nb long, message string"
    )


@dataclass(frozen=True)
class Measured:
    """What one scan tells of a table: a row of figures, and the checks over them.

    ``totals`` has ``rows``, the count of every further mark under its name, and, with an
    amount, its sum over the marked rows as ``amount_<name>``. ``absent`` are error rows.
    """

    totals: DataFrame
    checks: Sequence[str]
    absent: DataFrame | None

    def report(self) -> DataFrame:
        """All checks as rows ``(ordre, regle, controle, niveau, nb, message)``."""
        rows = _as_rows(self.totals, self.checks).filter(f"regle <> 'V1' OR niveau = '{WARNING}'")
        return rows if self.absent is None else rows.unionByName(self.absent)

    def with_checks(self, name: str) -> DataFrame:
        """The figures with all checks as one array of structs."""
        fixed = [] if self.absent is None else [r.asDict() for r in self.absent.collect()]
        checks = f"array({', '.join(self.checks)})"
        column = F.expr(f"filter({checks}, c -> c.regle <> 'V1' OR c.niveau = '{WARNING}')")
        for row in fixed:
            entry = F.struct(
                F.lit(row["ordre"]).alias("ordre"),
                *[F.lit(row[c]).alias(c) for c in ("regle", "controle", "niveau")],
                F.lit(row["nb"]).cast("long").alias("nb"),
                F.lit(row["message"]).alias("message"),
            )
            column = F.array_append(column, entry)
        return self.totals.withColumn(name, column)


def measure(
    df: DataFrame,
    rules: RuleSet,
    growers: DataFrame | None = None,
    cooperatives: DataFrame | None = None,
    marks: Mapping[str, str] | None = None,
    amount: str | None = None,
    local_rows: int = LOCAL_ROWS,
) -> Measured:
    """The rules and further ``marks`` (name: SQL condition) from one scan and one exchange.

    NaN counts as missing. References that are proven small are broadcast, larger ones joined
    in one exchange of the counted keys.
    """
    df = nan_to_null(df)
    wanted = {_KEY: [((2, "R2"), rules.key)], _GRADE: [((5, "R4"), rules.grade)]}
    if cooperatives is not None:
        wanted[_REGION] = [((6, "R4"), rules.region)]
        wanted[_COOPERATIVE] = [((9, "R6"), rules.cooperative)]
    if growers is not None:
        wanted[_GROWER] = [((8, "R6"), rules.grower)]
    # R7 compares the two columns of the grower's row.
    second = [((10, "R7"), c) for c in (rules.grower, rules.region)] if growers is not None else []
    needed = [n for checks in wanted.values() for n in checks] + second
    absent = [(*k, c) for k, c in needed if c not in df.columns]
    checked = {code: n[0][1] for code, n in wanted.items() if n[0][1] in df.columns}

    names, faults = {}, {}
    for family, conditions in _faults(df, rules).items():
        names[family] = {c: f"{family}_{i}" for i, c in enumerate(conditions)}
        faults |= {names[family][c]: x for c, x in conditions.items()}
    faults |= marks or {}
    counts = _stacked_counts(df, list(faults.values()), rules, checked, amount)
    references = _reference_rows(
        df.sparkSession,
        rules,
        growers if _GROWER in checked else None,
        cooperatives if {_REGION, _COOPERATIVE} & checked.keys() else None,
    )
    joined = _against_references(counts, references, local_rows)
    return Measured(
        _measured(joined, list(faults), rules),
        _local_checks(rules, names) + _key_checks(rules, checked, rules.region in df.columns),
        _absent_columns(df, absent) if absent else None,
    )


def validate(
    df: DataFrame,
    rules: RuleSet,
    growers: DataFrame | None = None,
    cooperatives: DataFrame | None = None,
    local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """All checks as rows ``(ordre, regle, controle, niveau, nb, message)``.

    NaN counts as missing. A rule gives an error row for each column that the table lacks.
    """
    return measure(df, rules, growers, cooperatives, local_rows=local_rows).report()


def verdict(checks: DataFrame, rows: Column) -> DataFrame:
    """One row: valid or not, checks by level, rows, and a summary line."""
    level = F.col("niveau")
    totals = checks.agg(
        (F.count_if(level == ERROR) == 0).alias("valide"),
        F.count_if(level == OK).alias("nb_ok"),
        F.count_if(level == ERROR).alias("nb_erreurs"),
        F.count_if(level == WARNING).alias("nb_avertissements"),
    ).withColumn("nb_lignes", rows)
    summary = F.format_string(
        "%s : %d regle(s) passee(s), %d erreur(s), %d avertissement(s) sur %s lignes",
        F.when(F.col("valide"), "QUALITE OK").otherwise("QUALITE KO"),
        "nb_ok", "nb_erreurs", "nb_avertissements", F.format_number("nb_lignes", 0),
    )
    return totals.withColumn("resume", summary)
