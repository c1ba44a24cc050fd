"""DuckDB SQL for the registered queries, on the same tables."""

from __future__ import annotations

import re

# Named parts of a WITH clause, in order of dependence.
PARTS = {
    "w0": """
        SELECT concat(l_orderkey, '-', l_linenumber) AS id_pesee,
               strftime(l_shipdate, '%Y-%m-%d') AS date,
               CASE WHEN l_orderkey % 991 = 0 THEN 'NATION_0'
                    WHEN l_partkey % 33 = 0 THEN lower(n_name)
                    WHEN l_partkey % 33 = 1 THEN concat(' ', n_name)
                    WHEN l_partkey % 33 = 2 THEN replace(n_name, '_', '-')
                    WHEN l_partkey % 33 = 3 THEN concat(n_name, ' ')
                    ELSE n_name END AS region,
               CASE WHEN l_partkey % 501 = 0 THEN 'Supplier#999999999'
                    WHEN l_suppkey % 29 = 0 THEN upper(s_name)
                    WHEN l_suppkey % 31 = 0 THEN replace(s_name, '#', '  ')
                    ELSE s_name END AS cooperative,
               concat('PLT', CASE WHEN l_orderkey % 997 = 0 THEN o_custkey + 1000000
                                  ELSE o_custkey END) AS id_planteur,
               l_quantity * CASE WHEN l_orderkey % 211 = 0 THEN 250 ELSE 25 END AS tonnage_kg,
               CASE WHEN l_returnflag = 'A' THEN 'Grade A'
                    WHEN l_returnflag = 'N' THEN 'Grade B'
                    WHEN l_linestatus = 'F' THEN 'Grade C'
                    ELSE 'Hors grade' END AS qualite,
               CASE WHEN l_partkey % 50 = 7 THEN -1
                    ELSE CAST(round_even(400 + l_extendedprice / 150, 0) AS BIGINT)
               END AS prix_fcfa_kg,
               CASE WHEN l_partkey % 16 <> 9 THEN 5 + l_discount * 50 END AS humidite_pct,
               l_partkey, l_suppkey, l_extendedprice, l_orderkey
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN supplier ON l_suppkey = s_suppkey""",
    "w": "SELECT * FROM w0 UNION ALL SELECT * FROM w0 WHERE l_orderkey % 67 = 0",
    "f": """
        SELECT id_pesee, date, region, cooperative, id_planteur, tonnage_kg, qualite,
               prix_fcfa_kg, humidite_pct FROM w""",
    "g": """
        SELECT concat('PLT', c_custkey) AS id_planteur, n_name AS region,
               0.5::DOUBLE + (c_custkey % 59) * 0.5::DOUBLE AS superficie_ha,
               CAST(2005 + c_custkey % 19 AS BIGINT) AS annee_adhesion,
               c_custkey % 5 = 0 AS certifie_bio
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "c": """
        SELECT s_name AS code_cooperative, n_name AS region, r_name AS zone_production,
               CASE WHEN r_name IN ('AFRICA', 'ASIA') THEN 'San Pedro' ELSE 'Abidjan' END
                   AS port_export
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "lr": "SELECT {key:region} AS k, max(region) AS official FROM c GROUP BY 1",
    "lc": "SELECT {key:code_cooperative} AS k, max(code_cooperative) AS official FROM c GROUP BY 1",
    "canon": """
        SELECT w.* REPLACE (coalesce(lr.official, w.region) AS region,
                            coalesce(lc.official, w.cooperative) AS cooperative)
        FROM w LEFT JOIN lr ON lr.k = {key:w.region}
        LEFT JOIN lc ON lc.k = {key:w.cooperative}""",
    "uniq": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY id_pesee
                ORDER BY date, l_partkey, l_suppkey, l_extendedprice) AS rn FROM canon)
        WHERE rn = 1""",
    "typed": """
        SELECT * REPLACE (strptime(date, '%Y-%m-%d')::DATE AS date),
               CAST(year(date::DATE) AS INTEGER) AS annee,
               CAST(month(date::DATE) AS INTEGER) AS mois,
               dayname(date::DATE) AS jour_semaine
        FROM uniq""",
    "enriched": """
        SELECT typed.*, superficie_ha, annee_adhesion, certifie_bio, zone_production, port_export,
               {campagne:mois} AS campagne,
               {saison:annee,mois} AS saison,
               {classe} AS categorie_tonnage
        FROM typed LEFT JOIN g USING (id_planteur)
        LEFT JOIN c ON typed.cooperative = c.code_cooperative""",
    "mp": """
        SELECT qualite, campagne, median(prix_fcfa_kg) AS m FROM enriched
        WHERE prix_fcfa_kg > 0 GROUP BY 1, 2""",
    "mh": "SELECT qualite, median(humidite_pct) AS m FROM enriched GROUP BY 1",
    "imp": """
        SELECT e.* REPLACE (
                   CAST(round_even(coalesce(CASE WHEN prix_fcfa_kg > 0 THEN prix_fcfa_kg END, mp.m),
                                   0) AS BIGINT) AS prix_fcfa_kg,
                   round_even(coalesce(humidite_pct, mh.m), 1) AS humidite_pct),
               prix_fcfa_kg <= 0 AS prix_impute,
               humidite_pct IS NULL AS humidite_imputee,
               coalesce(round_even(coalesce(humidite_pct, mh.m), 1) <= 8, false) AS conforme_export
        FROM enriched e LEFT JOIN mp ON e.qualite = mp.qualite AND e.campagne = mp.campagne
        LEFT JOIN mh ON e.qualite = mh.qualite""",
    "mg": "SELECT qualite, median(prix_fcfa_kg) AS m FROM imp GROUP BY 1",
    "meas": """
        SELECT imp.*, CAST(round_even(tonnage_kg * prix_fcfa_kg, 0) AS BIGINT) AS montant_fcfa,
               round_even((prix_fcfa_kg - mg.m) / mg.m * 100, 1) AS ecart_prix_grade_pct
        FROM imp LEFT JOIN mg USING (qualite)""",
    "clean": """
        SELECT id_pesee, date, region, cooperative, id_planteur, tonnage_kg, qualite, prix_fcfa_kg,
               humidite_pct, annee, mois, jour_semaine, superficie_ha, annee_adhesion, certifie_bio,
               zone_production, port_export, campagne, saison, conforme_export, categorie_tonnage,
               prix_impute, humidite_imputee, montant_fcfa, ecart_prix_grade_pct FROM meas""",
}

DEPENDS = {
    "w": ("w0",),
    "f": ("w",),
    "lr": ("c",),
    "lc": ("c",),
    "canon": ("w", "lr", "lc"),
    "uniq": ("canon",),
    "typed": ("uniq",),
    "enriched": ("typed", "g", "c"),
    "mp": ("enriched",),
    "mh": ("enriched",),
    "imp": ("enriched", "mp", "mh"),
    "mg": ("imp",),
    "meas": ("imp", "mg"),
    "clean": ("meas",),
}


def _key(column: str) -> str:
    return (
        f"coalesce(trim(regexp_replace(lower(strip_accents({column})), '[^a-z0-9]+', ' ', 'g')), '')"
    )


def _expand(sql: str) -> str:
    """Fill the expression placeholders ``{name:arguments}``."""
    def fill(match: re.Match) -> str:
        name, _, rest = match.group(1).partition(":")
        args = rest.split(",")
        if name == "key":
            return _key(args[0])
        if name == "campagne":
            return (
                f"CASE WHEN {args[0]} IN (10, 11, 12, 1, 2, 3)"
                " THEN 'Principale' ELSE 'Intermediaire' END"
            )
        if name == "saison":
            start = f"(CASE WHEN {args[1]} >= 10 THEN {args[0]} ELSE {args[0]} - 1 END)"
            return f"concat({start}, '-', {start} + 1)"
        return (
            "CASE WHEN tonnage_kg <= 0 THEN NULL WHEN tonnage_kg <= 100 THEN 'Petit (<100 kg)'"
            " WHEN tonnage_kg <= 500 THEN 'Moyen (100-500 kg)'"
            " WHEN tonnage_kg <= 1000 THEN 'Gros (500-1000 kg)'"
            " WHEN tonnage_kg > 1000 THEN 'Tres gros (>1000 kg)' END"
        )

    return re.sub(r"\{([a-z]+(?::[^}]*)?)\}", fill, sql)


def _with(*needed: str) -> str:
    wanted: set[str] = set()
    queue = list(needed)
    while queue:
        part = queue.pop()
        if part not in wanted:
            wanted.add(part)
            queue += DEPENDS.get(part, ())
    parts = [f"{name} AS ({sql})" for name, sql in PARTS.items() if name in wanted]
    return "WITH " + ",\n".join(parts) + "\n"


def _sql(needed: tuple[str, ...], body: str) -> str:
    return _expand((_with(*needed) if needed else "") + body)


_WEIGHTED = """
    SELECT {keys}, count(*) AS nb, CAST(sum(montant_fcfa) AS BIGINT) AS montant_fcfa,
           sum(tonnage_kg) AS tonnage_kg,
           round_even(CAST(sum(montant_fcfa) AS DOUBLE) / sum(tonnage_kg), 1) AS prix_moyen_pondere
    FROM {source} GROUP BY {keys}"""

_COLUMNS = {
    "id_pesee": "string", "date": "string", "region": "string", "cooperative": "string",
    "id_planteur": "string", "tonnage_kg": "double", "qualite": "string",
    "prix_fcfa_kg": "bigint", "humidite_pct": "double",
}

_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS colonne, '{t}' AS type,
        coalesce(substr((SELECT CAST({c} AS VARCHAR) FROM w WHERE {c} IS NOT NULL
            ORDER BY date, l_partkey, l_suppkey, l_extendedprice LIMIT 1), 1, 24), '-') AS exemple,
        count(DISTINCT {c}) AS valeurs_distinctes FROM w"""
    for c, t in _COLUMNS.items()
)

_MISSING = " UNION ALL ".join(
    f"""SELECT '{c}' AS colonne, count(*) - count({c}) AS nb_manquants,
        round_even((count(*) - count({c})) / count(*) * 100, 2) AS part_pct
        FROM f HAVING count({c}) < count(*)"""
    for c in _COLUMNS
)

_DISTRIBUTION = " UNION ALL ".join(
    f"""SELECT '{c}' AS mesure, count({c}) AS nombre,
        round_even(avg({c}), 1) AS moyenne, round_even(stddev_samp({c}), 1) AS ecart_type,
        round_even(CAST(min({c}) AS DOUBLE), 1) AS minimum,
        round_even(quantile_cont({c}, 0.25), 1) AS q25,
        round_even(quantile_cont({c}, 0.5), 1) AS q50,
        round_even(quantile_cont({c}, 0.75), 1) AS q75,
        round_even(CAST(max({c}) AS DOUBLE), 1) AS maximum FROM w"""
    for c in ("tonnage_kg", "prix_fcfa_kg", "humidite_pct")
)

_VARIANTS = " UNION ALL ".join(
    f"""SELECT '{c}' AS colonne, count(DISTINCT {c}) AS modalites_brutes,
        count(DISTINCT {{key:{c}}}) AS modalites_normalisees,
        count(DISTINCT {c}) - count(DISTINCT {{key:{c}}}) AS variantes_de_saisie FROM w"""
    for c in ("region", "cooperative", "qualite")
)


def _check(order: int, rule: str, name: str, bad: str, failed: str, passed: str, source: str) -> str:
    return f"""SELECT {order} AS ordre, '{rule}' AS regle, '{name}' AS controle,
        CASE WHEN {bad} > 0 THEN 'ERREUR' ELSE 'OK' END AS niveau, CAST({bad} AS BIGINT) AS nb,
        CASE WHEN {bad} > 0 THEN {failed} ELSE {passed} END AS message FROM {source}"""


def _rules(t: str, absent: tuple[str, ...] = ()) -> str:
    """All checks on table ``t``, with imputation warnings if it has the flags.

    Columns ``absent`` from it give error rows instead.
    """

    def comma(x: str) -> str:
        return f"format('{{:,}}', {x})"

    def unknown(column: str, known: str, name: str, most: int) -> str:
        return f"""(SELECT count(*) AS bad,
            concat('[''', array_to_string(list_slice(list(v ORDER BY v), 1, {most}), ''', '''), ''']')
                AS shown, (SELECT count(DISTINCT {column}) FROM {t}) AS total
            FROM (SELECT DISTINCT {column} AS v FROM {t}
                  WHERE {column} IS NOT NULL AND {column} NOT IN {known})) {name}"""

    critical = [c for c in _COLUMNS if c != "humidite_pct" and c not in absent]
    bounds = {"tonnage_kg": (1, 5000), "prix_fcfa_kg": (200, 2000), "humidite_pct": (0, 25)}
    bounds = {c: b for c, b in bounds.items() if c not in absent}
    nulls = ", ".join(f"count(*) - count({c}) AS m_{c}" for c in critical)
    outside = ", ".join(
        f"count(*) FILTER ({c} < {lo} OR {c} > {hi}) AS o_{c}" for c, (lo, hi) in bounds.items()
    )
    missing = ", ".join(
        f"CASE WHEN m_{c} > 0 THEN concat('{c} (', {comma('m_' + c)}, ')') END" for c in critical
    )
    beyond = ", ".join(
        f"CASE WHEN o_{c} > 0 THEN concat('{c} (', {comma('o_' + c)}, ' hors [{lo} ; {hi}])') END"
        for c, (lo, hi) in bounds.items()
    )
    grades = "('Grade A', 'Grade B', 'Grade C', 'Hors grade')"
    checks = [
        _check(
            1, "R1", "volume", "greatest(70000 - n, 0)",
            f"concat('R1 volume : ', {comma('n')}, ' lignes, en dessous du seuil de 70,000."
            " Extraction probablement incomplete.')",
            f"concat('R1 volume : ', {comma('n')}, ' lignes (seuil 70,000)')",
            f"(SELECT count(*) AS n FROM {t}) r1",
        ),
        _check(
            2, "R2", "unicite", "bad",
            f"concat('R2 unicite : ', {comma('bad')}, ' doublon(s) sur id_pesee."
            " Le dedoublonnage n''a pas ete applique.')",
            "'R2 unicite : aucun doublon sur id_pesee'",
            f"(SELECT count(*) - count(DISTINCT id_pesee) AS bad FROM {t}) r2",
        ),
        _check(
            4, "R3", "completude", "(" + " + ".join(f"m_{c}" for c in critical) + ")",
            f"concat('R3 completude : valeurs manquantes sur ', concat_ws(', ', {missing}))",
            f"'R3 completude : {len(critical)} colonnes critiques sans valeur manquante'",
            f"(SELECT {nulls} FROM {t}) r3",
        ),
        _check(
            5, "R4", "qualite", "bad",
            "concat('R4 domaine : grade(s) inconnu(s) ', shown, '. Attendus : [''Grade A'',"
            " ''Grade B'', ''Grade C'', ''Hors grade'']')",
            "'R4 domaine : tous les grades appartiennent au referentiel'",
            unknown("qualite", grades, "r4a", 1_000_000),
        ),
        _check(
            6, "R4", "region", "bad",
            "concat('R4 domaine : region(s) non normalisee(s) ', shown)",
            "concat('R4 domaine : ', total, ' regions, toutes normalisees')",
            unknown("region", "(SELECT region FROM c)", "r4b", 5),
        ),
        _check(
            7, "R5", "bornes", "(" + " + ".join(f"o_{c}" for c in bounds) + ")",
            f"concat('R5 bornes : ', concat_ws(', ', {beyond}))",
            "'R5 bornes : tonnage, prix et humidite dans les plages metier'",
            f"(SELECT {outside} FROM {t}) r5",
        ),
        _check(
            8, "R6", "id_planteur", "bad",
            f"concat('R6 integrite : ', {comma('bad')},"
            " ' pesee(s) referencent un planteur absent du referentiel')",
            "'R6 integrite : tous les planteurs existent au referentiel'",
            f"""(SELECT count(*) AS bad FROM {t} x WHERE NOT EXISTS
                (SELECT 1 FROM g WHERE g.id_planteur = x.id_planteur)) r6a""",
        ),
        _check(
            9, "R6", "cooperative", "bad",
            f"concat('R6 integrite : ', {comma('bad')},"
            " ' pesee(s) referencent une cooperative inconnue')",
            "'R6 integrite : toutes les cooperatives existent au referentiel'",
            f"""(SELECT count(*) AS bad FROM {t} x WHERE NOT EXISTS
                (SELECT 1 FROM c WHERE c.code_cooperative = x.cooperative)) r6b""",
        ),
        _check(
            10, "R7", "coherence", "bad",
            f"concat('R7 coherence : ', {comma('bad')},"
            " ' pesee(s) dont la region differe de celle du planteur au referentiel')",
            "'R7 coherence : region de la pesee identique a celle du planteur'",
            f"""(SELECT count(*) AS bad FROM {t} x LEFT JOIN g USING (id_planteur)
                WHERE coalesce(x.region <> g.region, true)) r7""",
        ),
    ]
    if "region" in absent:
        checks = [c for c in checks if "AS ordre" not in c or not c.startswith(("SELECT 6 ", "SELECT 10 "))]
    lacking = [(3, "R3", c, "R3 completude") for c in absent]
    lacking += [(o, r, "region", r) for o, r in ((6, "R4"), (10, "R7")) if "region" in absent]
    checks += [
        f"SELECT {order}, '{rule}', '{c}', 'ERREUR', 1, '{text} : colonne absente ''{c}'''"
        for order, rule, c, text in lacking
    ]
    if t == "clean":
        for flag, label in (("prix_impute", "prix"), ("humidite_imputee", "humidite")):
            checks.append(
                f"""SELECT 11, 'V1', '{flag}', 'AVERTISSEMENT', bad,
                concat(format('{{:.1f}}', round_even(bad / n * 100, 1)),
                       ' % des lignes ont une valeur de {label} imputee,',
                       ' prudence dans l''interpretation')
                FROM (SELECT count(*) FILTER ({flag}) AS bad, count(*) AS n FROM clean) v
                WHERE bad / n * 100 > 5"""
            )
    return " UNION ALL ".join(checks)


_ANOMALIES = """, fence AS (
    SELECT quantile_cont(tonnage_kg, 0.75)
           + 3 * (quantile_cont(tonnage_kg, 0.75) - quantile_cont(tonnage_kg, 0.25)) AS x FROM f),
grade AS (SELECT qualite, median(prix_fcfa_kg) AS m FROM f GROUP BY 1),
flags AS (
    SELECT id_pesee, tonnage_kg,
           coalesce(tonnage_kg > (SELECT x FROM fence), false) AS anomalie_tonnage,
           coalesce(humidite_pct > 8, false) AS anomalie_humidite,
           coalesce(abs(prix_fcfa_kg - m) / m > 0.30, false) AS anomalie_prix
    FROM f LEFT JOIN grade USING (qualite))
"""


def _anomaly(name: str, criterion: str, flag: str) -> str:
    return f"""SELECT '{name}' AS anomalie, {criterion} AS critere,
        count(*) FILTER ({flag}) AS nb_lignes,
        round_even(count(*) FILTER ({flag}) / count(*) * 100, 2) AS part_pct,
        round_even(coalesce(sum(tonnage_kg) FILTER ({flag}), 0), 1) AS tonnage_concerne_kg,
        'signale, conserve' AS action FROM flags"""


_CANONICAL = " UNION ALL ".join(
    f"""SELECT '{c}' AS colonne, count(DISTINCT {c}) AS modalites_avant,
    count(DISTINCT coalesce(official, {c})) AS modalites_apres,
    count(*) - count(official) AS non_resolus
    FROM w LEFT JOIN {t} ON {t}.k = {{key:w.{c}}}"""
    for c, t in (("region", "lr"), ("cooperative", "lc"))
)

_FAMILIES = " UNION ALL ".join(
    (
        _anomaly(
            "tonnage extreme",
            "concat('> ', format('{:,}', CAST((SELECT round_even(x, 0) FROM fence)"
            " AS BIGINT)), ' kg (Q3 + 3 x IQR)')",
            "anomalie_tonnage",
        ),
        _anomaly("humidite hors norme export", "'> 8.0 %'", "anomalie_humidite"),
        _anomaly(
            "prix atypique pour le grade",
            "'ecart > 30 % a la mediane du grade'",
            "anomalie_prix",
        ),
    )
)

_INTEGRITY = """SELECT 'id_planteur' AS cle, count(*) AS orphelins FROM w
    WHERE id_planteur NOT IN (SELECT id_planteur FROM g)
    UNION ALL SELECT 'cooperative', count(*) FROM w WHERE {key:w.cooperative} NOT IN
    (SELECT {key:code_cooperative} FROM c)
    UNION ALL SELECT 'region', count(*) FROM w WHERE {key:w.region} NOT IN
    (SELECT {key:region} FROM c)"""

_CLEAN_COLUMNS = (
    *_COLUMNS, "annee", "mois", "jour_semaine", "superficie_ha", "annee_adhesion", "certifie_bio",
    "zone_production", "port_export", "campagne", "saison", "conforme_export",
    "categorie_tonnage", "prix_impute", "humidite_imputee", "montant_fcfa",
    "ecart_prix_grade_pct",
)


def _entries(path: str, columns: str, source: str) -> str:
    """One row of path and text for each named value of a one-row source."""
    return " UNION ALL ".join(
        f"SELECT '{path}.{c}' AS chemin, CAST({c} AS VARCHAR) AS valeur FROM {source}"
        for c in columns.split()
    )


_AUDIT_ROWS = " UNION ALL ".join(
    [
        *[
            f"SELECT 'sources.{n}.fichier' AS chemin, '{f}' AS valeur"
            f" UNION ALL SELECT 'sources.{n}.nb_lignes', CAST(count(*) AS VARCHAR) FROM {t}"
            for n, f, t in (
                ("pesees", "lineitem", "w"), ("planteurs", "customer", "g"),
                ("cooperatives", "supplier", "c"),
            )
        ],
        """SELECT 'constats.doublons_id_pesee', CAST(count(*) - count(DISTINCT id_pesee) AS VARCHAR)
        FROM f""",
        """SELECT 'constats.doublons_lignes_completes',
        CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM f)) AS VARCHAR) FROM f""",
        """SELECT 'constats.prix_aberrants',
        CAST(count(*) FILTER (prix_fcfa_kg <= 0) AS VARCHAR) FROM w""",
        f"""SELECT concat('constats.valeurs_manquantes.', colonne), CAST(nb_manquants AS VARCHAR)
        FROM ({_MISSING})""",
        f"""SELECT concat('constats.variantes_saisie.', colonne),
        CAST(variantes_de_saisie AS VARCHAR) FROM ({_VARIANTS})""",
        "SELECT 'constats.periode.debut', min(date) FROM w",
        "SELECT 'constats.periode.fin', max(date) FROM w",
        f"""SELECT CASE cle WHEN 'id_planteur' THEN 'constats.integrite.orphelins_planteur'
        ELSE concat('constats.integrite.orphelins_', cle) END, CAST(orphelins AS VARCHAR)
        FROM ({_INTEGRITY})""",
    ]
)

_QUALITY_ROWS = (
    re.sub(r"FROM f\b", "FROM clean", _ANOMALIES).rstrip()
    + f""", checks AS ({_rules("clean")}), dedup AS (
        SELECT count(*) AS lignes_avant, count(*) - count(DISTINCT id_pesee) AS doublons_supprimes,
               count(DISTINCT id_pesee) AS lignes_apres FROM w),
    labels AS ({_CANONICAL}), families AS ({_FAMILIES}),
    holes AS ("""
    + " UNION ALL ".join(
        f"""SELECT {i} AS place, '{c}' AS colonne, count(*) - count({c}) AS n, count(*) AS total
        FROM clean"""
        for i, c in enumerate(_CLEAN_COLUMNS)
    )
    + ") "
    + " UNION ALL ".join(
        [
            "SELECT 'volumes.lignes_extraites' AS chemin, CAST(lignes_avant AS VARCHAR) AS valeur"
            " FROM dedup",
            "SELECT 'volumes.lignes_conservees', CAST(lignes_apres AS VARCHAR) FROM dedup",
            f"SELECT 'volumes.colonnes_finales', '{len(_CLEAN_COLUMNS)}'",
            *[
                _entries(
                    f"normalisation_libelles.{c}", "modalites_avant modalites_apres non_resolus",
                    f"(SELECT * FROM labels WHERE colonne = '{c}')",
                )
                for c in ("region", "cooperative")
            ],
            _entries("dedoublonnage", "lignes_avant doublons_supprimes lignes_apres", "dedup"),
            _entries(
                "imputation", "prix_impute humidite_imputee",
                "(SELECT count(*) FILTER (prix_impute) AS prix_impute,"
                " count(*) FILTER (humidite_imputee) AS humidite_imputee FROM clean)",
            ),
            "SELECT 'validation.valide', CAST(count(*) FILTER (niveau = 'ERREUR') = 0 AS VARCHAR)"
            " FROM checks",
            "SELECT 'validation.nb_lignes', CAST(lignes_apres AS VARCHAR) FROM dedup",
            *[
                f"""SELECT concat('validation.{name}.', row_number() OVER
                (ORDER BY ordre, controle) - 1), message FROM checks WHERE niveau = '{level}'"""
                for name, level in (
                    ("controles_passes", "OK"), ("erreurs", "ERREUR"),
                    ("avertissements", "AVERTISSEMENT"),
                )
            ],
            """SELECT concat('anomalies.', CASE anomalie WHEN 'tonnage extreme' THEN 0
                WHEN 'humidite hors norme export' THEN 1 ELSE 2 END),
            concat_ws('|', anomalie, critere, nb_lignes, CAST(part_pct AS DECIMAL(20, 2)),
                      CAST(tonnage_concerne_kg AS DECIMAL(20, 2)), action) FROM families""",
            """SELECT concat('valeurs_manquantes_restantes.', row_number() OVER (ORDER BY place) - 1),
            concat_ws('|', colonne, n, CAST(round_even(n / total * 100, 2) AS DECIMAL(20, 2)))
            FROM holes WHERE n > 0""",
        ]
    )
)

def _seasons(condition: str) -> str:
    """Season comparison over the first scan of every ticket whose date meets a condition."""
    return f""", u AS (SELECT strptime(date, '%Y-%m-%d')::DATE AS d, tonnage_kg FROM (
            SELECT *, row_number() OVER (PARTITION BY id_pesee
                ORDER BY date, l_partkey, l_suppkey, l_extendedprice) AS rn FROM w) WHERE rn = 1),
        m AS (SELECT CAST(year(d) - (month(d) < 10)::INTEGER AS INTEGER) AS debut,
                CAST(month(d) AS INTEGER) AS mois, count(*) AS nb, sum(tonnage_kg) AS tonnage_kg
            FROM u WHERE {condition} GROUP BY 1, 2),
        spine AS (SELECT CAST(y AS INTEGER) AS debut, CAST(x AS INTEGER) AS mois FROM
            (SELECT unnest(range((SELECT min(debut) FROM m), (SELECT max(debut) + 1 FROM m))) AS y),
            (SELECT unnest(range(1, 13)) AS x)),
        filled AS (SELECT debut, mois, coalesce(nb, 0) AS nb, coalesce(tonnage_kg, 0) AS tonnage_kg
            FROM spine LEFT JOIN m USING (debut, mois))
        SELECT concat(debut, '-', debut + 1) AS saison, mois, nb, tonnage_kg,
            lag(nb) OVER before AS nb_precedent, lag(tonnage_kg) OVER before AS tonnage_precedent,
            round_even((tonnage_kg - lag(tonnage_kg) OVER before)
                / nullif(lag(tonnage_kg) OVER before, 0) * 100, 1) AS evolution_pct
        FROM filled WINDOW before AS (PARTITION BY mois ORDER BY debut)"""


ORACLES: dict[str, str] = {
    "flagship_weighted_price": _sql(
        ("meas",), _WEIGHTED.replace("{keys}", "qualite, saison").replace("{source}", "meas")
    ),
    "canonical_labels": _sql(("canon",), "SELECT id_pesee, region, cooperative FROM canon"),
    "canonical_stats": _sql(
        ("w", "lr", "lc"),
        " UNION ALL ".join(
            f"""SELECT '{c}' AS colonne, count(DISTINCT {c}) AS modalites_avant,
            count(DISTINCT coalesce(official, {c})) AS modalites_apres,
            count(*) - count(official) AS non_resolus
            FROM w LEFT JOIN {t} ON {t}.k = {{key:w.{c}}}"""
            for c, t in (("region", "lr"), ("cooperative", "lc"))
        ),
    ),
    "canonical_words": _sql(
        (),
        """WITH words AS (
            SELECT word, count(*) AS n FROM
                (SELECT unnest(regexp_split_to_array(text, '[ \\n\\t\\r]+')) AS word FROM documents)
            GROUP BY 1)
        SELECT {key:word} AS cle, count(*) AS graphies, CAST(sum(n) AS BIGINT) AS emplois
        FROM words GROUP BY 1""",
    ),
    "label_collisions": _sql(
        ("w",),
        """SELECT {key:region} AS label_key, count(DISTINCT region) AS n,
        min(region) AS first_label, max(region) AS last_label
        FROM w GROUP BY 1 HAVING count(DISTINCT region) > 1""",
    ),
    "label_variant_counts": _sql(("w",), _VARIANTS),
    "label_variant_sample": _sql(
        ("w",),
        """SELECT DISTINCT region AS label FROM w
        WHERE region <> trim(region) OR region <> array_to_string(list_transform(
            regexp_extract_all(region, '[A-Za-z]+|[^A-Za-z]+'),
            lambda x: concat(upper(x[1]), lower(x[2:]))), '')
        ORDER BY 1 LIMIT 6""",
    ),
    "label_forms": _sql(
        ("w",),
        """SELECT DISTINCT region, trim(region) AS nettoye, array_to_string(list_transform(
            regexp_extract_all(region, '[A-Za-z]+|[^A-Za-z]+'),
            lambda x: concat(upper(x[1]), lower(x[2:]))), '') AS titre FROM w""",
    ),
    "dedup_first": _sql(
        ("w",),
        """SELECT id_pesee, date, region, cooperative, id_planteur, tonnage_kg, qualite,
               prix_fcfa_kg, humidite_pct FROM (
            SELECT *, row_number() OVER (PARTITION BY id_pesee
                ORDER BY date, l_partkey, l_suppkey, l_extendedprice) AS rn FROM w) WHERE rn = 1""",
    ),
    "dedup_counts": _sql(
        ("f",),
        """SELECT count(*) AS lignes, count(DISTINCT id_pesee) AS cles,
        count(*) - count(DISTINCT id_pesee) AS doublons_cle,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM f)) AS doublons_complets FROM f""",
    ),
    "dedup_stats": _sql(
        ("w",),
        """SELECT count(*) AS lignes_avant, count(*) - count(DISTINCT id_pesee)
        AS doublons_supprimes, count(DISTINCT id_pesee) AS lignes_apres FROM w""",
    ),
    "calendar_columns": _sql(
        ("w",),
        """SELECT id_pesee, date, CAST(year(date::DATE) AS INTEGER) AS annee,
        CAST(month(date::DATE) AS INTEGER) AS mois, dayname(date::DATE) AS jour_semaine,
        {campagne:month(date::DATE)} AS campagne,
        {saison:year(date::DATE),month(date::DATE)} AS saison FROM w""",
    ),
    "enrich_left": _sql(
        ("w", "g", "c"),
        """SELECT id_pesee, w.id_planteur, w.cooperative, superficie_ha, annee_adhesion,
        certifie_bio, zone_production, port_export FROM w LEFT JOIN g USING (id_planteur)
        LEFT JOIN c ON w.cooperative = c.code_cooperative""",
    ),
    "reference_key_check": _sql(
        ("w",), "SELECT id_pesee, count(*) AS n FROM w GROUP BY 1 HAVING count(*) > 1"
    ),
    "orphans_exact": _sql(
        ("w", "c"),
        """SELECT cooperative AS key, count(*) AS n FROM w WHERE NOT EXISTS
        (SELECT 1 FROM c WHERE c.code_cooperative = w.cooperative) GROUP BY 1""",
    ),
    "orphans_canonical": _sql(
        ("w", "c"),
        """SELECT count(*) AS orphelins FROM w WHERE {key:w.cooperative} NOT IN
        (SELECT {key:code_cooperative} FROM c)""",
    ),
    "integrity_audit": _sql(
        ("w", "g", "c"),
        """SELECT 'id_planteur' AS cle, count(*) AS orphelins FROM w
        WHERE id_planteur NOT IN (SELECT id_planteur FROM g)
        UNION ALL SELECT 'cooperative', count(*) FROM w WHERE {key:w.cooperative} NOT IN
        (SELECT {key:code_cooperative} FROM c)
        UNION ALL SELECT 'region', count(*) FROM w WHERE {key:w.region} NOT IN
        (SELECT {key:region} FROM c)""",
    ),
    "hierarchy_mismatch": _sql(
        ("w", "g"),
        """SELECT count(*) FILTER (g.id_planteur IS NULL) AS orphelins,
        count(*) FILTER (coalesce(w.region <> g.region, true)) AS incoherents
        FROM w LEFT JOIN g ON w.id_planteur = g.id_planteur""",
    ),
    "tonnage_class": _sql(
        ("w",), "SELECT id_pesee, tonnage_kg, {classe} AS categorie_tonnage FROM w"
    ),
    "export_flag": _sql(
        ("w",),
        """SELECT id_pesee, humidite_pct, coalesce(humidite_pct <= 8, false) AS conforme_export
        FROM w""",
    ),
    "impute_price": _sql(
        ("imp",), "SELECT id_pesee, qualite, campagne, prix_fcfa_kg, prix_impute FROM imp"
    ),
    "impute_humidity": _sql(
        ("imp",), "SELECT id_pesee, humidite_pct, humidite_imputee, conforme_export FROM imp"
    ),
    "impute_stats": _sql(
        ("imp",),
        """SELECT count(*) FILTER (prix_impute) AS prix_impute,
        count(*) FILTER (humidite_imputee) AS humidite_imputee FROM imp""",
    ),
    "measures": _sql(
        ("meas",), "SELECT id_pesee, prix_fcfa_kg, montant_fcfa, ecart_prix_grade_pct FROM meas"
    ),
    "profile": _sql(("w",), _PROFILE),
    "missing": _sql(("f",), _MISSING),
    "distributions": _sql(("w",), _DISTRIBUTION),
    "ranked_quantiles": """SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
        median(l_extendedprice) AS mediane, quantile_cont(l_extendedprice, 0.75) AS q3
        FROM lineitem GROUP BY 1""",
    "bracketed_quantiles": """SELECT round_even(quantile_cont(x, 0.25), 3) AS q1,
        round_even(median(x), 3) AS mediane, round_even(quantile_cont(x, 0.75), 3) AS q3,
        round_even(quantile_cont(x, 0.99), 3) AS q99
        FROM (SELECT l_extendedprice * 1000 + l_orderkey % 997 + l_linenumber / 8 AS x FROM lineitem) t""",
    "sketched_quantiles": """SELECT DISTINCT l_returnflag, true AS q1_juste, true AS mediane_juste,
        true AS q3_juste FROM lineitem""",
    "grower_medians": _sql(
        ("w",),
        """SELECT id_planteur, median(tonnage_kg) AS tonnage_median,
        median(prix_fcfa_kg) AS prix_median FROM w GROUP BY 1""",
    ),
    "period": _sql(
        ("w",),
        """SELECT min(date) AS debut, max(date) AS fin,
        CAST(max(date)::DATE - min(date)::DATE AS INTEGER) AS jours FROM w""",
    ),
    "sentinel_count": _sql(
        ("w",), "SELECT count(*) FILTER (prix_fcfa_kg <= 0) AS prix_aberrants FROM w"
    ),
    "rules_report": _sql(("f", "g", "c"), _rules("f")),
    "rules_clean": _sql(("clean", "g", "c"), _rules("clean")),
    "rules_verdict": _sql(
        ("f", "g", "c"),
        f"""SELECT nb_erreurs = 0 AS valide, *, concat(
            CASE WHEN nb_erreurs = 0 THEN 'QUALITE OK' ELSE 'QUALITE KO' END, ' : ', nb_ok,
            ' regle(s) passee(s), ', nb_erreurs, ' erreur(s), ', nb_avertissements,
            ' avertissement(s) sur ', format('{{:,}}', nb_lignes), ' lignes') AS resume
        FROM (SELECT count(*) FILTER (niveau = 'OK') AS nb_ok,
                     count(*) FILTER (niveau = 'ERREUR') AS nb_erreurs,
                     count(*) FILTER (niveau = 'AVERTISSEMENT') AS nb_avertissements,
                     (SELECT count(*) FROM f) AS nb_lignes FROM ({_rules("f")}))""",
    ),
    "anomalies": _sql(
        ("f",),
        _ANOMALIES
        + " UNION ALL ".join(
            (
                _anomaly(
                    "tonnage extreme",
                    "concat('> ', format('{:,}', CAST((SELECT round_even(x, 0) FROM fence)"
                    " AS BIGINT)), ' kg (Q3 + 3 x IQR)')",
                    "anomalie_tonnage",
                ),
                _anomaly("humidite hors norme export", "'> 8.0 %'", "anomalie_humidite"),
                _anomaly(
                    "prix atypique pour le grade",
                    "'ecart > 30 % a la mediane du grade'",
                    "anomalie_prix",
                ),
            )
        ),
    ),
    "anomaly_rows": _sql(("f",), _ANOMALIES + "SELECT * FROM flags"),
    "grade_summary": _sql(
        ("f",),
        """SELECT qualite, count(id_pesee) AS nb, round_even(avg(prix_fcfa_kg), 1) AS prix_moyen,
        round_even(avg(humidite_pct), 1) AS humidite_moyenne
        FROM f WHERE prix_fcfa_kg > 0 GROUP BY 1 ORDER BY 3 DESC""",
    ),
    "season_share": _sql(
        ("f",),
        """SELECT lower({campagne:month(date::DATE)}) AS campagne, count(id_pesee) AS nb_pesees,
        sum(tonnage_kg) AS tonnage_kg,
        round_even(sum(tonnage_kg) / sum(sum(tonnage_kg)) OVER () * 100, 1) AS part_pct
        FROM f WHERE prix_fcfa_kg > 0 GROUP BY 1""",
    ),
    "usable_pairs": _sql(
        ("f", "c"),
        """SELECT count(*) AS couples FROM (SELECT DISTINCT region, cooperative FROM f
        WHERE region IN (SELECT region FROM c)
        AND cooperative IN (SELECT code_cooperative FROM c))""",
    ),
    "multi_parent_keys": _sql(
        ("w",), "SELECT cooperative FROM w GROUP BY 1 HAVING count(DISTINCT region) > 1"
    ),
    "hierarchy_check": _sql(
        ("f", "g", "c"),
        """, usable AS (SELECT * FROM f WHERE region IN (SELECT region FROM c)
            AND cooperative IN (SELECT code_cooperative FROM c))
        SELECT count(*) AS lignes_exploitables,
        (SELECT count(*) FROM (SELECT DISTINCT region, cooperative FROM usable)) AS couples,
        (SELECT count(*) FROM (SELECT id_planteur FROM g GROUP BY 1
            HAVING count(DISTINCT region) > 1)) AS planteurs_multi_region FROM usable""",
    ),
    "unknown_regions": _sql(
        ("w", "c"), "SELECT DISTINCT region AS valeur FROM w EXCEPT SELECT region FROM c"
    ),
    "tiered_price": _sql(
        ("w", "g"),
        """SELECT id_pesee, prix_fcfa_kg, CAST(round_even(CAST(prix_fcfa_kg AS DOUBLE)
            * CASE WHEN certifie_bio THEN 1.10::DOUBLE ELSE 1.0::DOUBLE END
            * CASE WHEN month(date::DATE) IN (10, 11, 12, 1, 2, 3) THEN 1.0::DOUBLE
                   ELSE 0.96::DOUBLE END
            * CASE WHEN tonnage_kg >= 500 THEN 1.03::DOUBLE WHEN tonnage_kg < 100 THEN 0.97::DOUBLE
                   ELSE 1.0::DOUBLE END, 0) AS BIGINT) AS prix_ajuste
        FROM w LEFT JOIN g USING (id_planteur)""",
    ),
    "clip_values": _sql(
        ("w",),
        """SELECT id_pesee, CASE WHEN humidite_pct IS NOT NULL
            THEN greatest(6.0, least(9.0, humidite_pct)) END AS humidite_bornee,
        CASE WHEN tonnage_kg IS NOT NULL THEN greatest(100.0, tonnage_kg) END AS tonnage_plancher
        FROM w""",
    ),
    "date_spine_weights": _sql(
        ("w",),
        """, spine AS (SELECT unnest(generate_series(min(date)::DATE, max(date)::DATE,
            INTERVAL 1 DAY))::DATE AS jour FROM w),
        brut AS (SELECT jour, CAST(CASE month(jour) WHEN 1 THEN 0.12 WHEN 2 THEN 0.06
            WHEN 3 THEN 0.04 WHEN 4 THEN 0.04 WHEN 5 THEN 0.06 WHEN 6 THEN 0.07 WHEN 7 THEN 0.05
            WHEN 8 THEN 0.03 WHEN 9 THEN 0.04 WHEN 10 THEN 0.16 WHEN 11 THEN 0.18 ELSE 0.15 END
            AS DOUBLE) * CASE WHEN dayofweek(jour) = 0 THEN 0.25::DOUBLE ELSE 1.0::DOUBLE END AS b
            FROM spine)
        SELECT strftime(jour, '%Y-%m-%d') AS jour, round_even(b / sum(b) OVER (), 9) AS poids FROM brut""",
    ),
    "union_duplicates": _sql(("f",), "SELECT * FROM f ORDER BY date, id_pesee"),
    "preview": _sql(
        ("clean",),
        """SELECT id_pesee, strftime(date, '%Y-%m-%d') AS date, qualite, tonnage_kg, prix_fcfa_kg
        FROM clean ORDER BY date, id_pesee LIMIT 5""",
    ),
    "compliance_by_month": _sql(
        ("imp",),
        """SELECT saison, campagne, mois, count(*) AS nb, sum(tonnage_kg) AS tonnage_kg,
        count(*) FILTER (conforme_export) AS nb_conformes,
        round_even(count(*) FILTER (conforme_export) / count(*) * 100, 1) AS taux_conformite_pct
        FROM imp WHERE NOT humidite_imputee GROUP BY 1, 2, 3""",
    ),
    "class_distribution": _sql(
        ("w",),
        """SELECT {classe} AS categorie_tonnage, count(*) AS nb, sum(tonnage_kg) AS tonnage_kg,
        round_even(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100, 1) AS part_pct
        FROM w GROUP BY 1""",
    ),
    "measured_weighted_price": _sql(
        ("meas",),
        _WEIGHTED.replace("{keys}", "qualite").replace(
            "{source}", "(SELECT * FROM meas WHERE NOT prix_impute)"
        ),
    ),
    "star_dimension": _sql(
        ("g",),
        """SELECT row_number() OVER (ORDER BY id_planteur) AS cle_planteur, id_planteur,
        superficie_ha, annee_adhesion, certifie_bio FROM g""",
    ),
    "star_fact": _sql(
        ("clean", "g", "c"),
        """, dr AS (SELECT region, row_number() OVER (ORDER BY region) AS id_region
            FROM (SELECT DISTINCT region FROM c)),
        dc AS (SELECT code_cooperative, row_number() OVER (ORDER BY code_cooperative)
            AS id_cooperative FROM c),
        dp AS (SELECT id_planteur, row_number() OVER (ORDER BY id_planteur) AS cle_planteur FROM g)
        SELECT id_region, id_cooperative, cle_planteur, id_pesee, montant_fcfa
        FROM clean LEFT JOIN dr USING (region)
        LEFT JOIN dc ON clean.cooperative = dc.code_cooperative LEFT JOIN dp USING (id_planteur)""",
    ),
    "clean_fact": _sql(
        ("clean",), "SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM clean"
    ),
    "audit_rows": _sql(("w", "f", "g", "c"), _AUDIT_ROWS),
    "quality_rows": _sql(("w", "lr", "lc", "clean", "g", "c"), _QUALITY_ROWS),
    "rules_unknown_grades": _sql(
        ("f", "g", "c"),
        """, lots AS (SELECT * REPLACE (CASE WHEN prix_fcfa_kg % 5 = 0
            THEN concat('Lot ', prix_fcfa_kg % 60) ELSE qualite END AS qualite) FROM f) """
        + _rules("lots"),
    ),
    "rules_nan": _sql(
        ("f", "g", "c"),
        """, holes AS (SELECT * REPLACE (
            CASE WHEN prix_fcfa_kg % 7 <> 3 THEN tonnage_kg END AS tonnage_kg,
            CASE WHEN prix_fcfa_kg % 7 <> 3 THEN humidite_pct END AS humidite_pct) FROM f) """
        + _rules("holes"),
    ),
    "rules_absent_columns": _sql(
        ("f", "g", "c"),
        ", lacking AS (SELECT * EXCLUDE (region, tonnage_kg) FROM f) "
        + _rules("lacking", ("region", "tonnage_kg")),
    ),
    "csv_text_round_trip": """SELECT doc_id,
        concat('"a""b" \\ ', text, ', \\n"', chr(10), '"') AS text FROM documents""",
    "csv_round_trip": _sql(("f",), "SELECT * FROM f"),
    "stage_round_trip": _sql(("f",), "SELECT * FROM f"),
    "season_comparison": _sql(("w",), _seasons("true")),
    "season_comparison_gaps": _sql(("w",), _seasons("year(d) % 2 = 0 OR month(d) IN (2, 11)")),
    "stable_keys": _sql(
        ("g",),
        """, a AS (SELECT id_planteur, row_number() OVER (ORDER BY id_planteur) AS k
            FROM g WHERE NOT certifie_bio),
        b AS (SELECT id_planteur, row_number() OVER (ORDER BY id_planteur) + (SELECT count(*) FROM a) AS k
            FROM g WHERE certifie_bio AND superficie_ha >= 2)
        SELECT k AS cle_planteur, id_planteur, CASE WHEN superficie_ha >= 2 THEN region END AS region,
            CASE WHEN superficie_ha >= 2 THEN superficie_ha END AS superficie_ha
        FROM (SELECT * FROM a UNION ALL SELECT * FROM b) k JOIN g USING (id_planteur)""",
    ),
    "sketched_distincts": _sql(
        ("f",),
        """SELECT partie, colonne, true AS juste
        FROM (SELECT DISTINCT qualite AS partie FROM f UNION ALL SELECT unnest(['toutes', 'sans A'])) p,
            (SELECT unnest(['id_pesee', 'id_planteur', 'prix_fcfa_kg', 'tonnage_kg']) AS colonne) c""",
    ),
    "csv_rejects": _sql(
        ("w",),
        """SELECT id_pesee, NULL::VARCHAR AS colonne, CASE WHEN l_partkey % 101 = 3
            THEN 'cellules en trop' ELSE 'cellules manquantes' END AS raison, NULL::VARCHAR AS texte
        FROM w WHERE l_partkey % 101 = 3 OR l_partkey % 103 = 5
        UNION ALL SELECT id_pesee, 'tonnage_kg', 'valeur illisible', 'lourd'
        FROM w WHERE l_partkey % 101 <> 3 AND l_partkey % 107 = 7
        UNION ALL SELECT id_pesee, 'date', 'date illisible', '31/02/2020'
        FROM w WHERE l_partkey % 101 <> 3 AND l_partkey % 109 = 11""",
    ),
    "csv_rejects_kept": _sql(
        ("w",),
        """SELECT id_pesee, CASE WHEN l_partkey % 109 <> 11 THEN date END AS date, region, cooperative,
            id_planteur, CASE WHEN l_partkey % 107 <> 7 THEN tonnage_kg END AS tonnage_kg, qualite,
            CASE WHEN l_partkey % 103 <> 5 THEN prix_fcfa_kg END AS prix_fcfa_kg,
            CASE WHEN l_partkey % 103 <> 5 THEN humidite_pct END AS humidite_pct
        FROM w WHERE l_partkey % 101 <> 3""",
    ),
}


def _found(path: str, text: bool = False) -> str:
    value = f"(SELECT valeur FROM r WHERE chemin = '{path}')"
    return f"'\"', {value}, '\"'" if text else value


def _fields_of(path: str, *names: str) -> str:
    """The text of a JSON object from entries of a report."""
    return ", ',', ".join(f"'\"{n}\":', {_found(f'{path}.{n}')}" for n in names)


def _map_of(path: str) -> str:
    return f"""'{{', (SELECT coalesce(string_agg(concat('"', substr(chemin, {len(path) + 2}), '":', valeur), ','
        ORDER BY chemin), '') FROM r WHERE starts_with(chemin, '{path}.')), '}}'"""


_SOURCES = ", ',', ".join(
    f"""'"{n}":{{"fichier":', {_found(f"sources.{n}.fichier", True)},
        ',"nb_lignes":', {_found(f"sources.{n}.nb_lignes")}, '}}'"""
    for n in ("pesees", "planteurs", "cooperatives")
)
ORACLES |= {
    "bucketed_first": ORACLES["dedup_first"],
    "audit_json": _with("w", "f", "g", "c")
    + f""", r AS ({_expand(_AUDIT_ROWS)}) SELECT concat('{{"sources":{{', {_SOURCES},
        '}},"constats":{{"valeurs_manquantes":', {_map_of("constats.valeurs_manquantes")}, ',',
        {_fields_of("constats", "doublons_id_pesee", "doublons_lignes_completes")},
        ',"variantes_saisie":', {_map_of("constats.variantes_saisie")}, ',',
        {_fields_of("constats", "prix_aberrants")},
        ',"periode":{{"debut":', {_found("constats.periode.debut", True)},
        ',"fin":', {_found("constats.periode.fin", True)}, '}},"integrite":{{',
        {_fields_of("constats.integrite", "orphelins_planteur", "orphelins_cooperative", "orphelins_region")},
        '}}}}}}') AS rapport""",
    "self_check": f"""SELECT 'prix_par_grade' AS controle, qualite AS cle, nb, CAST(prix_moyen AS DOUBLE)
            AS premiere, CAST(humidite_moyenne AS DOUBLE) AS seconde FROM ({ORACLES["grade_summary"]})
        UNION ALL SELECT 'repartition_campagne', campagne, nb_pesees, tonnage_kg, part_pct
            FROM ({ORACLES["season_share"]})
        UNION ALL SELECT 'hierarchie', 'toutes', lignes_exploitables, couples, planteurs_multi_region
            FROM ({ORACLES["hierarchy_check"]})""",
    "reference_guard": _sql(
        ("g",),
        """SELECT 'unique' AS reference, count(*) > count(DISTINCT id_planteur) AS refusee FROM g
        UNION ALL SELECT 'repetee', count(*) > 0 FROM g WHERE superficie_ha > 29
        UNION ALL SELECT 'cle manquante', count(id_planteur) > count(DISTINCT id_planteur)
            FROM g WHERE NOT certifie_bio""",
    ),
    "tolerant_dates": _sql(
        ("w",),
        """SELECT id_pesee, texte, strftime(try_strptime(texte, '%Y-%m-%d'), '%Y-%m-%d') AS jour
        FROM (SELECT id_pesee, CASE l_partkey % 9 WHEN 0 THEN replace(date, '-', '/')
            WHEN 1 THEN concat(substr(date, 1, 5), '13-01') WHEN 2 THEN '' ELSE date END AS texte FROM w)""",
    ),
    "tonnage_class_text": _sql(
        ("w",),
        """SELECT id_pesee, coalesce({classe}, 'nan') AS categorie_tonnage
        FROM (SELECT * REPLACE (CASE WHEN prix_fcfa_kg % 7 <> 3 THEN tonnage_kg END AS tonnage_kg) FROM w)""",
    ),
    "label_order": _sql(
        ("c",),
        """, spelled AS (SELECT CASE WHEN code_cooperative LIKE '%1' THEN lower(region) ELSE region END AS region,
            -CAST(regexp_extract(code_cooperative, '([0-9]+)$', 1) AS BIGINT) AS position FROM c),
        firsts AS (SELECT region, min(position) AS position FROM spelled GROUP BY 1)
        SELECT lower(replace(region, '_', ' ')) AS label_key, arg_max(region, position) AS official
        FROM firsts GROUP BY 1""",
    ),
}
