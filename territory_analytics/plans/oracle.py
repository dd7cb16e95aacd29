"""SQL counterparts of the registered queries, written for DuckDB over the same tables.

Each text stands on shared WITH parts that name the stand-in tables and the marts.
"""

from .. import fixed_values as V
from ..functions.colours import palette_of
from .standin import DS

_KIND = (
    "CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'SMALL') THEN 'Appartement' "
    "WHEN p_type IN ('MEDIUM', 'LARGE') THEN 'Maison' ELSE 'Immeuble' END"
)
_TYPE = (
    "CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'SMALL') THEN 'appartement' "
    "WHEN p_type IN ('MEDIUM', 'LARGE') THEN 'maison' ELSE 'autre' END"
)
_LETTER = "substring('ABCDEFG', l_linenumber, 1)"
_GES = "CASE l_returnflag WHEN 'R' THEN 'F' WHEN 'A' THEN 'C' ELSE 'E' END"
_LINES = "lineitem JOIN part ON p_partkey = l_partkey"


def _band(x: str) -> str:
    return (
        f"CASE WHEN {x} >= 150 OR {x} IS NULL THEN '150+' WHEN {x} >= 100 THEN '100-150' "
        f"WHEN {x} >= 70 THEN '70-100' WHEN {x} >= 40 THEN '40-70' ELSE '<40' END"
    )


def _score(z: str, share: str) -> str:
    return (
        f"round(0.6::DOUBLE * greatest(-coalesce({z}, 0::DOUBLE), 0::DOUBLE) * 50 "
        f"+ 0.4::DOUBLE * coalesce({share}, 0::DOUBLE), 1)"
    )


def _by_type(fact: str, communes: str) -> str:
    return f"""
        SELECT t.*, nom, departement, region FROM (
          SELECT code_insee, type_bien, median(prix_m2) AS prix_m2_median, count(*) AS nb_dpe,
            round(100.0::DOUBLE * avg((etiquette IN ('F', 'G'))::INTEGER), 2) AS pct_passoires,
            median(cout_energie_annuel) AS cout_energie_annuel_median,
            median(annee_construction) AS annee_construction_mediane
          FROM {fact} GROUP BY ALL) t JOIN {communes} USING (code_insee)"""


def _type_parents(mart_type: str) -> str:
    return f"""
        SELECT departement, type_bien, median(prix_m2_median) AS prix_m2_median_dpt,
          avg(prix_m2_median) AS mean, stddev_pop(prix_m2_median) AS spread
        FROM {mart_type} WHERE nb_dpe >= 30 GROUP BY ALL"""


def _scored(mart_type: str, parents: str) -> str:
    return f"""
        SELECT *, z < -1.0 AS est_opportunite, {_score('z', 'pct_passoires')} AS score_opportunite,
          CASE WHEN coalesce(z >= -1.0, true) THEN 'survalorisee'
            WHEN pct_passoires >= 20 THEN 'sous-cotee + parc passoires (potentiel renovation)'
            ELSE 'sous-cotee' END AS etiquette_opportunite
        FROM (
          SELECT m.*, prix_m2_median_dpt, round((prix_m2_median - mean) / nullif(spread, 0), 3) AS z,
            round(100.0::DOUBLE * (prix_m2_median - prix_m2_median_dpt) / nullif(prix_m2_median_dpt, 0), 1)
              AS ecart_pct
          FROM {mart_type} m JOIN {parents} USING (departement, type_bien) WHERE nb_dpe >= 30)"""



def _whole(text: str) -> str:
    return f"TRY_CAST({text} AS INTEGER)"


# Shared WITH parts, each on the given tables or the parts before it.
_PARTS = {
    "raw_sales": f"""
        SELECT CAST(l_suppkey AS VARCHAR) AS code_commune, {_KIND} AS type_local,
          CASE WHEN l_tax = 0.08 THEN '95d' ELSE CAST(l_quantity * 4 AS VARCHAR) END AS surface_reelle_bati,
          CASE WHEN l_discount = 0.1 THEN '0' ELSE CAST(l_extendedprice * 4 AS VARCHAR) END AS valeur_fonciere,
          CASE WHEN l_linenumber = 7 THEN '2026' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date_mutation,
          l_suppkey % 14 - 5 AS lon, 41 + l_suppkey % 10 AS lat
        FROM {_LINES}""",
    "sales": f"""
        SELECT CAST(l_suppkey AS VARCHAR) AS code_insee, {_TYPE} AS type_bien, l_quantity * 4 AS surface,
          l_extendedprice * 4 AS prix, l_extendedprice * 4 / (l_quantity * 4) AS prix_m2
        FROM {_LINES}
        WHERE p_type <> 'PROMO' AND l_extendedprice > 0 AND l_quantity * 4 >= 9
          AND l_extendedprice * 4 / (l_quantity * 4) BETWEEN 200 AND 40000""",
    "raw_certs": f"""
        SELECT 'D' || l_orderkey || '-' || l_linenumber AS numero,
          CASE WHEN l_discount = 0.09 THEN '2026-01' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date_txt,
          CASE WHEN l_quantity <> 13 THEN printf('%05d', l_suppkey) END AS code_insee,
          l_suppkey || '0' AS code_postal, 'Commune ' || l_suppkey AS nom_commune,
          lower({_KIND}) AS type_batiment,
          CASE WHEN l_tax = 0 THEN NULL WHEN l_tax = 0.01 THEN '0' WHEN l_tax = 0.02 THEN 'abc'
            ELSE CAST(l_quantity * 4 AS VARCHAR) END AS area_txt,
          CASE WHEN p_size = 50 THEN '' ELSE (1900 + p_size) || '.6' END AS year_txt,
          {_LETTER} AS etiquette, {_GES} AS ges, p_retailprice AS conso,
          CASE WHEN l_discount = 0.05 THEN '95f' ELSE CAST(l_quantity AS VARCHAR) END AS emission_txt,
          l_extendedprice AS cout, lower(l_linestatus) AS energie
        FROM {_LINES}""",
    "typed_certs": f"""
        SELECT numero AS numero_dpe, '{DS}' AS dt, code_insee, code_postal, nom_commune, type_batiment,
          TRY_CAST(area_txt AS DOUBLE) AS surface_habitable, {_whole('year_txt')} AS annee_construction,
          etiquette AS etiquette_dpe, ges AS etiquette_ges, conso AS conso_energie,
          TRY_CAST(emission_txt AS DOUBLE) AS emission_ges, cout AS cout_energie_annuel,
          energie AS energie_chauffage, TRY_CAST(date_txt AS DATE) AS date_etablissement
        FROM raw_certs
        WHERE code_insee IS NOT NULL AND (area_txt IS NULL OR TRY_CAST(area_txt AS DOUBLE) > 0)""",
    "clean_certs": """
        SELECT * EXCLUDE (place) FROM (
          SELECT *, row_number() OVER (PARTITION BY numero_dpe ORDER BY
            date_etablissement DESC NULLS LAST, dt DESC NULLS LAST, code_insee DESC NULLS LAST,
            code_postal DESC NULLS LAST, nom_commune DESC NULLS LAST, type_batiment DESC NULLS LAST,
            surface_habitable DESC NULLS LAST, annee_construction DESC NULLS LAST,
            etiquette_dpe DESC NULLS LAST, etiquette_ges DESC NULLS LAST, conso_energie DESC NULLS LAST,
            emission_ges DESC NULLS LAST, cout_energie_annuel DESC NULLS LAST,
            energie_chauffage DESC NULLS LAST) AS place
          FROM typed_certs) WHERE place = 1""",
    "clean_sold": """
        SELECT lpad(code_commune, 5, '0') AS code_insee,
          CASE type_local WHEN 'Appartement' THEN 'appartement' ELSE 'maison' END AS type_bien,
          TRY_CAST(surface_reelle_bati AS DOUBLE) AS surface, TRY_CAST(valeur_fonciere AS DOUBLE) AS prix,
          TRY_CAST(valeur_fonciere AS DOUBLE) / TRY_CAST(surface_reelle_bati AS DOUBLE) AS prix_m2,
          TRY_CAST(date_mutation AS DATE) AS date_mutation,
          CAST(lon AS DOUBLE) AS longitude, CAST(lat AS DOUBLE) AS latitude
        FROM raw_sales
        WHERE type_local <> 'Immeuble' AND TRY_CAST(valeur_fonciere AS DOUBLE) > 0
          AND TRY_CAST(surface_reelle_bati AS DOUBLE) >= 9
          AND TRY_CAST(valeur_fonciere AS DOUBLE) / TRY_CAST(surface_reelle_bati AS DOUBLE)
            BETWEEN 200 AND 40000""",
    "communes": """
        SELECT CAST(s_suppkey AS VARCHAR) AS code_insee, s_name AS nom, r_name AS departement,
          CASE WHEN r_regionkey < 3 THEN 'NORD' ELSE 'SUD' END AS region,
          CAST(floor(s_acctbal) AS BIGINT) AS population
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
        WHERE s_acctbal > 0""",
    "geo": """
        SELECT CAST(s_suppkey AS VARCHAR) AS code_insee,
          CASE WHEN s_suppkey % 17 <> 0 THEN CAST(41 + s_suppkey % 10 AS DOUBLE) END AS latitude,
          CASE WHEN s_suppkey % 17 <> 0 THEN CAST(s_suppkey % 14 - 5 AS DOUBLE) END AS longitude,
          CASE WHEN s_acctbal < 1000 THEN '{bad' WHEN s_acctbal < 2000 THEN '' WHEN s_acctbal < 3000 THEN NULL
            ELSE '{"type":"Point","coordinates":[' || (s_suppkey % 14 - 5) || ',' || (41 + s_suppkey % 10) || ']}'
          END AS geometry_json
        FROM supplier""",
    "homes": f"""
        SELECT CAST(l_suppkey AS VARCHAR) AS code_insee, {_LETTER} AS etiquette, {_TYPE} AS type_bien,
          {_band('l_quantity * 4')} AS tranche_surface, l_quantity * 4 AS surface, {_GES} AS etiquette_ges,
          CAST(1900 + p_size AS INTEGER) AS annee_construction, p_retailprice AS conso_energie,
          l_quantity AS emission_ges, l_extendedprice AS cout_energie_annuel,
          lower(l_linestatus) AS energie_chauffage, CAST(l_shipdate AS DATE) AS date_etablissement
        FROM {_LINES}""",
    "by_band": f"""
        SELECT code_insee, type_bien, {_band('surface')} AS tranche_surface, median(prix_m2) AS prix_m2
        FROM sales GROUP BY ALL""",
    "by_area": "SELECT code_insee, type_bien, median(prix_m2) AS prix_m2 FROM sales GROUP BY ALL",
    "fact": f"""
        SELECT '{DS}' AS dt, h.code_insee, h.etiquette, h.type_bien, h.tranche_surface, h.surface,
          coalesce(b.prix_m2, a.prix_m2) AS prix_m2, h.surface * coalesce(b.prix_m2, a.prix_m2) AS prix,
          h.etiquette_ges, h.annee_construction, h.conso_energie, h.emission_ges, h.cout_energie_annuel,
          h.energie_chauffage, CAST(h.date_etablissement AS VARCHAR) AS date_etablissement
        FROM homes h
        LEFT JOIN by_band b USING (code_insee, type_bien, tranche_surface)
        LEFT JOIN by_area a ON a.code_insee = h.code_insee AND a.type_bien = h.type_bien
        WHERE h.code_insee IN (SELECT code_insee FROM communes)""",
    "kpi": """
        SELECT code_insee, median(prix_m2) AS prix_m2_median,
          round(100.0::DOUBLE * avg((etiquette IN ('F', 'G'))::INTEGER), 2) AS pct_passoires,
          avg(prix_m2) FILTER (etiquette IN ('F', 'G')) AS dear,
          avg(prix_m2) FILTER (etiquette NOT IN ('F', 'G')) AS base, count(*) AS nb_transactions
        FROM fact GROUP BY code_insee""",
    "areas": """
        SELECT code_insee, median(prix_m2) AS prix_m2_median, count(*) AS nb_dpe,
          round(100.0::DOUBLE * avg((etiquette IN ('F', 'G'))::INTEGER), 2) AS pct_passoires,
          round(avg(conso_energie), 1) AS conso_energie_moy, round(avg(emission_ges), 1) AS emission_ges_moy,
          median(cout_energie_annuel) AS cout_energie_annuel_median,
          median(annee_construction) AS annee_construction_mediane,
          round(100.0::DOUBLE * avg((etiquette_ges IN ('F', 'G'))::INTEGER), 2) AS pct_ges_passoires
        FROM fact GROUP BY code_insee""",
    "parents": """
        SELECT departement, median(prix_m2_median) AS mid, avg(prix_m2_median) AS mean,
          stddev_pop(prix_m2_median) AS spread
        FROM areas JOIN communes USING (code_insee) GROUP BY departement""",
    "mart": """
        SELECT code_insee, nom, departement, region, population, prix_m2_median, nb_dpe, pct_passoires,
          conso_energie_moy, emission_ges_moy, cout_energie_annuel_median, annee_construction_mediane,
          pct_ges_passoires, nb_dpe >= 30 AS fiable,
          round(100.0::DOUBLE * (prix_m2_median - mid) / nullif(mid, 0), 1) AS indice_sous_cotation,
          round((prix_m2_median - mean) / nullif(spread, 0), 3) AS z_prix_dpt,
          rank() OVER (PARTITION BY departement ORDER BY prix_m2_median DESC NULLS LAST) AS rang_prix_dpt
        FROM areas JOIN communes USING (code_insee) JOIN parents USING (departement)""",
    "mart_type": _by_type("fact", "communes"),
    "type_parents": _type_parents("mart_type"),
    "scored": _scored("mart_type", "type_parents"),
    "run_type": _by_type("run_fact", "run_communes"),
    "run_parents": _type_parents("run_type"),
    "run_scored": _scored("run_type", "run_parents"),
    "market": """
        SELECT coalesce(nom, code_insee) AS commune, code_insee, departement, region, 'tous' AS type_bien,
          CAST(NULL AS VARCHAR) AS etiquette, prix_m2_median AS prix_m2, CAST(NULL AS DOUBLE) AS surface,
          nb_dpe, pct_passoires, conso_energie_moy AS conso_energie_med, emission_ges_moy,
          cout_energie_annuel_median, annee_construction_mediane, pct_ges_passoires, indice_sous_cotation,
          z_prix_dpt AS z, CAST(NULL AS DOUBLE) AS score_opportunite, latitude, longitude, geometry_json
        FROM mart LEFT JOIN geo USING (code_insee)""",
    "deals": """
        SELECT coalesce(nom, code_insee) AS commune, code_insee, departement, region, type_bien,
          CAST(NULL AS VARCHAR) AS etiquette, prix_m2_median AS prix_m2, CAST(NULL AS DOUBLE) AS surface,
          nb_dpe, pct_passoires, CAST(NULL AS DOUBLE) AS conso_energie_med, cout_energie_annuel_median,
          annee_construction_mediane, ecart_pct AS indice_sous_cotation, z, score_opportunite,
          latitude, longitude, geometry_json, est_opportunite
        FROM scored LEFT JOIN geo USING (code_insee)""",
    "shown": "SELECT * FROM market WHERE nb_dpe >= 30",
    "served": """
        SELECT *, CASE WHEN pct_passoires >= 20 THEN 'sous-cotee + parc passoires' ELSE 'sous-cotee' END
          AS etiquette_opportunite
        FROM deals
        WHERE type_bien IN ('appartement', 'maison') AND nb_dpe >= 30
          AND (coalesce(z, 0) <= -1.0 OR coalesce(indice_sous_cotation, 0) < 0)""",
    "run_communes": """
        SELECT * REPLACE (printf('%05d', CAST(code_insee AS BIGINT)) AS code_insee) FROM communes""",
    "run_homes": f"""
        SELECT code_insee, etiquette_dpe AS etiquette,
          CASE type_batiment WHEN 'immeuble' THEN 'autre' ELSE type_batiment END AS type_bien,
          {_band('surface_habitable')} AS tranche_surface, annee_construction, cout_energie_annuel
        FROM clean_certs
        WHERE surface_habitable > 0 AND code_insee IN (SELECT code_insee FROM run_communes)""",
    "run_band": f"""
        SELECT code_insee, type_bien, {_band('surface')} AS tranche_surface, median(prix_m2) AS prix_m2
        FROM clean_sold GROUP BY ALL""",
    "run_area": "SELECT code_insee, type_bien, median(prix_m2) AS prix_m2 FROM clean_sold GROUP BY ALL",
    "run_fact": """
        SELECT h.*, coalesce(b.prix_m2, a.prix_m2) AS prix_m2 FROM run_homes h
        LEFT JOIN run_band b USING (code_insee, type_bien, tranche_surface)
        LEFT JOIN run_area a ON a.code_insee = h.code_insee AND a.type_bien = h.type_bien""",
    "area_named": """
        SELECT code_insee, type_bien, departement, prix_m2 FROM by_area JOIN communes USING (code_insee)""",
}

_NEEDS = {
    "typed_certs": ["raw_certs"],
    "clean_certs": ["typed_certs"],
    "clean_sold": ["raw_sales"],
    "by_band": ["sales"],
    "by_area": ["sales"],
    "fact": ["homes", "by_band", "by_area", "communes"],
    "kpi": ["fact"],
    "areas": ["fact"],
    "parents": ["areas", "communes"],
    "mart": ["areas", "communes", "parents"],
    "mart_type": ["fact", "communes"],
    "type_parents": ["mart_type"],
    "scored": ["mart_type", "type_parents"],
    "market": ["mart", "geo"],
    "deals": ["scored", "geo"],
    "shown": ["market"],
    "served": ["deals"],
    "area_named": ["by_area", "communes"],
    "run_communes": ["communes"],
    "run_homes": ["clean_certs", "run_communes"],
    "run_band": ["clean_sold"],
    "run_area": ["clean_sold"],
    "run_fact": ["run_homes", "run_band", "run_area"],
    "run_type": ["run_fact", "run_communes"],
    "run_parents": ["run_type"],
    "run_scored": ["run_type", "run_parents"],
}


def _with(needs: str, body: str) -> str:
    """``body`` behind the shared parts it names and all parts those stand on."""
    ordered: list[str] = []

    def add(part):
        for base in _NEEDS.get(part, []):
            add(base)
        if part not in ordered:
            ordered.append(part)

    for part in needs.split():
        add(part)
    listed = ",\n".join(f"{part} AS ({_PARTS[part]})" for part in ordered)
    return f"WITH {listed}\n{body}" if listed else body


def _quantile(p: float) -> str:
    return f"round(quantile_cont(prix_m2, {p}))"


_SPREAD = f"""
    SELECT code_insee, type_bien, nom, departement, region, count(*) AS nb_transactions,
      {_quantile(0.1)} AS prix_m2_p10, {_quantile(0.25)} AS prix_m2_p25, {_quantile(0.5)} AS prix_m2_median,
      {_quantile(0.75)} AS prix_m2_p75, {_quantile(0.9)} AS prix_m2_p90
    FROM sales JOIN communes USING (code_insee)
    GROUP BY code_insee, type_bien, nom, departement, region HAVING count(*) >= 5"""


def _colour(metric: str, low: str, high: str, palette) -> str:
    start, end = palette
    share = f"greatest(0::DOUBLE, least(1::DOUBLE, ({metric} - {low}) / ({high} - {low})))"
    channels = zip(("rouge", "vert", "bleu"), V.NO_VALUE_COLOUR, start, end)
    columns = [
        f"CASE WHEN {metric} IS NULL THEN {grey} "
        f"ELSE CAST(round_even({a} + {b - a} * {share}, 0) AS INTEGER) END AS {name}"
        for name, grey, a, b in channels
    ]
    return ", ".join([*columns, f"CASE WHEN {metric} IS NULL THEN 150 ELSE 185 END AS opacite"])


def _range(rows: str, metric: str) -> str:
    return (
        f"SELECT coalesce(min({metric}), 0::DOUBLE) AS low, CASE WHEN max({metric}) > min({metric}) "
        f"THEN max({metric}) ELSE coalesce(min({metric}), 0::DOUBLE) + 1 END AS high FROM {rows}"
    )


_LOCATED = "SELECT * FROM shown WHERE latitude IS NOT NULL AND longitude IS NOT NULL"
_PAYLOADS = """payloads AS (
    SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS nom, s_nationkey,
      CASE WHEN s_nationkey NOT IN (3, 4) THEN (41 + s_suppkey % 10) + 0.25::DOUBLE END AS latitude,
      CASE WHEN s_nationkey = 3 THEN NULL WHEN s_nationkey = 4 THEN 1.5::DOUBLE
        ELSE CAST((s_suppkey % 14 - 5) || '.5' AS DOUBLE) END AS longitude,
      CASE WHEN s_nationkey NOT IN (3, 4) THEN '{"type":"Polygon"}' END AS contour
    FROM supplier)"""
_CENTRES = """centres AS (
    SELECT CAST(c_custkey AS VARCHAR) AS code_insee, c_name AS nom, CAST(c_nationkey AS DOUBLE) AS latitude,
      CAST(c_custkey % 180 AS DOUBLE) AS longitude
    FROM customer)"""

ORACLE = {
    "keep_latest": """
        SELECT user_id, event_type, event_id, value FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n
          FROM events) WHERE n = 1""",
    "safe_casts": _with("raw_certs", f"""
        SELECT TRY_CAST(area_txt AS DOUBLE) AS surface, {_whole('year_txt')} AS annee,
          TRY_CAST(emission_txt AS DOUBLE) AS emission, TRY_CAST(date_txt AS DATE) IS NULL AS sans_date,
          count(*) AS n
        FROM raw_certs GROUP BY ALL"""),
    "clean_certificates": _with("clean_certs", """
        SELECT * REPLACE (CAST(date_etablissement AS VARCHAR) AS date_etablissement) FROM clean_certs"""),
    "clean_sales": _with("clean_sold", """
        SELECT * REPLACE (CAST(date_mutation AS VARCHAR) AS date_mutation) FROM clean_sold"""),
    "type_case": f"SELECT {_TYPE} AS type_bien, count(*) AS n FROM {_LINES} GROUP BY ALL",
    "area_band": f"""
        SELECT {_band('l_quantity * 4')} AS tranche, count(*) AS n, min(l_quantity) * 4 AS surface_min,
          max(l_quantity) * 4 AS surface_max FROM {_LINES} GROUP BY ALL""",
    "known_area_semi": _with("homes communes", """
        SELECT code_insee, etiquette, count(*) AS n FROM homes
        WHERE etiquette <> 'A' AND code_insee IN (SELECT code_insee FROM communes) GROUP BY ALL"""),
    "ref_price_band": _with("by_band", "SELECT * FROM by_band"),
    "ref_price_fallback": _with("by_area", "SELECT * FROM by_area"),
    "enriched_fact": _with("fact", "SELECT * FROM fact"),
    "price_quantiles": _with("sales communes", _SPREAD),
    "quantiles_by_counting": _with("sales communes", _SPREAD),
    "exact_median_whole_table": """
        SELECT count(*) AS n, median(l_extendedprice / l_quantity) AS prix_m2_median,
          median(l_quantity) AS surface_mediane FROM lineitem""",
    "area_kpi": _with("kpi", f"""
        SELECT '{DS}' AS dt, code_insee, prix_m2_median, pct_passoires,
          round(100.0::DOUBLE * (dear - base) / nullif(base, 0), 2) AS decote_passoire_pct, nb_transactions
        FROM kpi"""),
    "discount_filtered_avg": _with("fact", """
        SELECT type_bien, round(100.0::DOUBLE * (dear - base) / nullif(base, 0), 2) AS decote_pct,
          nb_passoires, nb
        FROM (SELECT type_bien, avg(prix_m2) FILTER (etiquette IN ('F', 'G')) AS dear,
            avg(prix_m2) FILTER (etiquette NOT IN ('F', 'G')) AS base,
            count(*) FILTER (etiquette IN ('F', 'G')) AS nb_passoires, count(*) AS nb
          FROM fact GROUP BY type_bien)"""),
    "area_profile": _with("mart", "SELECT * FROM mart"),
    "area_type_profile": _with("mart_type", "SELECT * FROM mart_type"),
    "rank_in_parent": _with("area_named", """
        SELECT *, rank() OVER (PARTITION BY departement, type_bien ORDER BY prix_m2 DESC) AS rang
        FROM area_named"""),
    "rank_by_counting": """
        SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice,
          rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS rang FROM lineitem""",
    "zscore_in_parent": _with("area_named", """
        SELECT code_insee, type_bien, round((prix_m2 - avg(prix_m2) OVER w)
          / nullif(stddev_pop(prix_m2) OVER w, 0), 3) AS z
        FROM area_named WINDOW w AS (PARTITION BY departement, type_bien)"""),
    "gap_to_median": _with("area_named", """
        SELECT code_insee, type_bien, mediane_parent,
          round(100.0::DOUBLE * (prix_m2 - mediane_parent) / nullif(mediane_parent, 0), 1) AS ecart_pct
        FROM (SELECT *, median(prix_m2) OVER (PARTITION BY departement, type_bien) AS mediane_parent
          FROM area_named)"""),
    "flagship_opportunities": _with("scored", "SELECT * FROM scored"),
    "opportunity_count": _with("scored", """
        SELECT count(*) AS nb_opportunites FROM scored WHERE est_opportunite"""),
    "quality_counts": _with("fact", """
        SELECT unnest(['not_empty', 'code_insee_null', 'bad_dpe', 'future_date']) AS rule,
          unnest([count(*), 0, 0, 0]) AS n, unnest([count(*) > 0, true, true, true]) AS passed FROM fact"""),
    "quality_counts_dirty": _with("raw_certs", """
        SELECT unnest(['not_empty', 'code_insee_null', 'bad_dpe', 'future_date']) AS rule,
          unnest([n, nulls, bad, n]) AS n, unnest([n > 0, nulls = 0, bad = 0, n = 0]) AS passed
        FROM (SELECT count(*) AS n, count(*) - count(code_insee) AS nulls,
          count(*) FILTER (etiquette = 'G') AS bad FROM raw_certs)"""),
    "filter_compile": _with("homes communes", """
        SELECT nom AS commune, type_bien, etiquette, count(*) AS n
        FROM homes JOIN communes USING (code_insee)
        WHERE region = 'NORD' AND type_bien <> 'autre' AND etiquette IN ('F', 'G')
          AND surface BETWEEN 40 AND 120 GROUP BY ALL"""),
    "market_view": _with("market", "SELECT * FROM market"),
    "commune_grain": _with("shown", """
        SELECT commune, departement, region, prix_m2, nb_dpe FROM shown
        WHERE region = 'NORD' AND prix_m2 BETWEEN 1000 AND 4000"""),
    "clustered_market": _with("shown", """
        SELECT commune, departement, region, prix_m2, nb_dpe FROM shown
        WHERE region = 'NORD' AND prix_m2 BETWEEN 1000 AND 4000"""),
    "clustered_dwellings": _with("homes communes", """
        SELECT nom AS commune, type_bien, etiquette, count(*) AS n
        FROM homes JOIN communes USING (code_insee)
        WHERE region = 'NORD' AND type_bien IN ('appartement', 'maison') AND etiquette IN ('F', 'G')
          AND surface BETWEEN 40 AND 120 GROUP BY ALL"""),
    "opportunity_view": _with("deals", "SELECT * FROM deals"),
    "typed_grain": _with("deals", """
        SELECT commune, type_bien, prix_m2, nb_dpe FROM deals WHERE type_bien = 'maison' AND nb_dpe >= 30"""),
    "city_alias": """
        SELECT n_name, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey
        WHERE r_name IN ('ASIA', 'EUROPE') OR n_name = 'NATION_1' GROUP BY n_name""",
    "serve_opportunities": _with("served", "SELECT * FROM served"),
    "serve_opportunities_fallback": _with("shown", """
        SELECT * REPLACE (round_even(0.6::DOUBLE * greatest(-coalesce(z, 0::DOUBLE), 0::DOUBLE) * 50
            + 0.4::DOUBLE * coalesce(pct_passoires, 0::DOUBLE), 1) AS score_opportunite),
          CASE WHEN pct_passoires >= 20 THEN 'sous-cotee + parc passoires' ELSE 'sous-cotee' END
            AS etiquette_opportunite
        FROM shown WHERE coalesce(z, 0) <= -0.5 OR coalesce(indice_sous_cotation, 0) < 0"""),
    "label_distribution_topn": _with("fact communes", """
        , counts AS (SELECT nom AS commune, etiquette, count(*) AS nb FROM fact
          JOIN communes USING (code_insee) WHERE etiquette IN ('F', 'G') GROUP BY ALL)
        SELECT * FROM counts WHERE commune IN (
          SELECT commune FROM counts GROUP BY commune ORDER BY sum(nb) DESC, commune LIMIT 25)"""),
    "label_order": _with("fact communes", """
        SELECT nom AS commune, etiquette, count(*) AS nb, CAST(strpos('ABCDEFG', etiquette) AS BIGINT) AS place
        FROM fact JOIN communes USING (code_insee) GROUP BY ALL"""),
    "filter_choices": _with("market mart_type", """
        SELECT 'region' AS filtre, region AS valeur FROM market WHERE region IS NOT NULL
        UNION SELECT 'departement', departement FROM market WHERE departement IS NOT NULL
        UNION SELECT 'commune', commune FROM market
        UNION SELECT 'type_bien', type_bien FROM mart_type
        UNION SELECT 'etiquette', unnest(['A', 'B', 'C', 'D', 'E', 'F', 'G'])"""),
    "filter_options": _with("market", """
        SELECT greatest(0, CAST(floor(min(prix_m2) / 100) * 100 AS BIGINT)) AS prix_m2_min,
          CAST(floor(max(prix_m2) / 100) * 100 + 500 AS BIGINT) AS prix_m2_max,
          CAST(0 AS BIGINT) AS surface_min, CAST(150 AS BIGINT) AS surface_max FROM market"""),
    "slider_bounds_areas": _with("homes communes", """
        SELECT greatest(0, CAST(floor(min(cout_energie_annuel) / 100) * 100 AS BIGINT)) AS prix_m2_min,
          CAST(floor(max(cout_energie_annuel) / 100) * 100 + 500 AS BIGINT) AS prix_m2_max,
          CAST(0 AS BIGINT) AS surface_min,
          greatest(150, CAST(floor(max(surface) / 10) * 10 + 20 AS BIGINT)) AS surface_max
        FROM homes WHERE code_insee IN (SELECT code_insee FROM communes)"""),
    "present_types": _with("mart_type", "SELECT DISTINCT type_bien FROM mart_type"),
    "compare": _with("market", """
        SELECT commune, prix_m2, pct_passoires, conso_energie_med, indice_sous_cotation, nb_dpe FROM market
        WHERE commune IN ('Supplier#000000003', 'Supplier#000000004', 'Supplier#000000005',
          'Supplier#000000007')"""),
    "compare_long": _with("market", """
        SELECT commune, unnest(['prix_m2', 'pct_passoires', 'conso_energie_med', 'indice_sous_cotation'])
            AS indicateur,
          unnest([prix_m2, pct_passoires, conso_energie_med, indice_sous_cotation]) AS valeur
        FROM market"""),
    "compare_normalised": _with("market", """
        SELECT commune, unnest(['prix_m2', 'pct_passoires', 'conso_energie_med']) AS indicateur,
          unnest([round(prix_m2 / max(prix_m2) OVER (), 6), round(pct_passoires / max(pct_passoires) OVER (), 6),
            round(conso_energie_med / max(conso_energie_med) OVER (), 6)]) AS score_normalise
        FROM market"""),
    "headline_kpis": _with("shown", """
        SELECT count(DISTINCT commune) AS communes, round(avg(pct_passoires), 8) AS pct_passoires_moyen,
          CAST(sum(nb_dpe) AS BIGINT) AS nb_dpe, round(avg(indice_sous_cotation), 8) AS sous_cotation_moyenne,
          count(*) FILTER (nb_dpe >= 30) AS communes_fiables, max(pct_passoires) AS pct_passoires_max,
          median(prix_m2) AS prix_m2_median FROM shown"""),
    "energy_kpis": _with("shown", """
        SELECT round(avg(pct_passoires), 8) AS pct_passoires_moyen, round(avg(pct_ges_passoires), 8) AS pct_ges_moyen,
          count(DISTINCT commune) AS communes, CAST(sum(nb_dpe) AS BIGINT) AS nb_dpe,
          median(conso_energie_med) AS conso_mediane, median(cout_energie_annuel_median) AS cout_median
        FROM shown"""),
    "map_kpis": _with("shown", f"""
        SELECT count(*) AS lignes, round(avg(pct_passoires), 8) AS pct_passoires_moyen,
          CAST(sum(nb_dpe) AS BIGINT) AS nb_dpe, median(prix_m2) AS prix_m2_median FROM ({_LOCATED})"""),
    "opportunity_kpis": _with("served", """
        SELECT count(*) AS opportunites, max(score_opportunite) AS meilleur_score,
          min(indice_sous_cotation) AS ecart_min, round(avg(pct_passoires), 8) AS pct_passoires_moyen,
          count(*) FILTER (pct_passoires >= 20) AS double_signal FROM served"""),
    "signals": _with("shown", """
        SELECT (SELECT commune FROM shown ORDER BY prix_m2 DESC NULLS LAST, commune LIMIT 1)
            AS commune_plus_chere,
          (SELECT max(prix_m2) FROM shown) AS prix_m2_max,
          (SELECT commune FROM shown ORDER BY pct_passoires DESC NULLS LAST, commune LIMIT 1)
            AS commune_renovation,
          (SELECT max(pct_passoires) FROM shown) AS pct_passoires_max"""),
    "top_price": _with("shown", """
        SELECT commune, prix_m2, departement FROM shown WHERE prix_m2 IS NOT NULL
        ORDER BY prix_m2 DESC, commune LIMIT 20"""),
    "top_cost": _with("shown", """
        SELECT commune, cout_energie_annuel_median, pct_ges_passoires FROM shown
        WHERE cout_energie_annuel_median IS NOT NULL
        ORDER BY cout_energie_annuel_median DESC, commune LIMIT 20"""),
    "by_sieve_share": _with("shown", "SELECT commune, pct_passoires FROM shown ORDER BY 2 DESC NULLS LAST"),
    "badges": _with("served", """
        SELECT commune, type_bien, CASE WHEN indice_sous_cotation < 0 AND pct_passoires >= 20
            THEN 'sous-cotee · parc passoires' WHEN indice_sous_cotation < 0 THEN 'sous-cotee'
            WHEN pct_passoires >= 20 THEN 'parc passoires' ELSE '' END AS badges
        FROM served"""),
    "leaderboard": _with("served", """
        SELECT commune, departement, type_bien, prix_m2, score_opportunite,
          concat_ws(' · ', CASE WHEN indice_sous_cotation < 0 THEN 'sous-cotee' END,
            CASE WHEN pct_passoires >= 20 THEN 'parc passoires' END) AS badges
        FROM served
        ORDER BY score_opportunite DESC NULLS LAST, indice_sous_cotation NULLS LAST, commune, type_bien
        LIMIT 5"""),
    "double_signal": _with("served", """
        SELECT commune, type_bien, score_opportunite FROM served WHERE pct_passoires >= 20"""),
    "latest_partition": """
        SELECT o_orderkey, o_orderpriority, CAST(CAST(date_trunc('year', o_orderdate) AS DATE) AS VARCHAR) AS dt
        FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""",
    "map_points": _with("shown", f"SELECT commune, latitude, longitude FROM ({_LOCATED})"),
    "metric_range": _with("shown", _range("shown", "prix_m2")),
    "map_centre": _with("shown", f"""
        SELECT coalesce(round(avg(latitude), 8), 46.8) AS latitude,
          coalesce(round(avg(longitude), 8), 2.4) AS longitude FROM ({_LOCATED})"""),
    "map_features": _with("shown", f"""
        , located AS ({_LOCATED}), ends AS ({_range('located', 'prix_m2')})
        SELECT commune, {_colour('prix_m2', '(SELECT low FROM ends)', '(SELECT high FROM ends)', V.PALETTE_PRICE)},
          'Feature' AS genre, 'Point' AS forme, commune AS nom_affiche, nb_dpe AS nb_affiche
        FROM located WHERE json_valid(geometry_json) AND geometry_json <> ''"""),
    "map_point_features": _with("shown", f"""
        , located AS ({_LOCATED}), ends AS ({_range('located', 'pct_passoires')})
        SELECT commune,
          {_colour('pct_passoires', '(SELECT low FROM ends)', '(SELECT high FROM ends)', V.PALETTE_SIEVES)},
          longitude AS lon, latitude AS lat FROM located"""),
    "map_opportunities": _with("deals", f"""
        , located AS ({_LOCATED.replace('shown', 'deals')}), ends AS ({_range('located', 'score_opportunite')})
        SELECT commune, type_bien, {_colour('score_opportunite', '(SELECT low FROM ends)',
          '(SELECT high FROM ends)', palette_of('score_opportunite'))}
        FROM located WHERE json_valid(geometry_json) AND geometry_json <> ''"""),
    "map_layer_points": _with("shown", f"""
        , located AS ({_LOCATED}), ends AS ({_range('located', 'pct_passoires')})
        SELECT commune,
          {_colour('pct_passoires', '(SELECT low FROM ends)', '(SELECT high FROM ends)', V.PALETTE_SIEVES)},
          longitude AS lon, latitude AS lat FROM located"""),
    "dimension_tables": """
        SELECT 'dim_commune' AS dimension, CAST(s_suppkey AS VARCHAR) AS cle FROM supplier
        UNION SELECT 'dim_commune', CAST(c_custkey AS VARCHAR) FROM customer
        UNION SELECT 'dim_dpe', unnest(['A', 'B', 'C', 'D', 'E', 'F', 'G'])
        UNION SELECT 'dim_type_bien', unnest(['appartement', 'maison', 'autre'])""",
    "arrondissement_names": """
        SELECT CASE WHEN c_nationkey % 3 = 1 THEN 'Lyon ' || (CASE c_custkey % 9 WHEN 0 THEN '1er'
            ELSE (c_custkey % 9 + 1) || 'e' END) || ' Arrondissement'
          ELSE 'Paris 2e Arrondissement' END AS member, count(*) AS n
        FROM customer WHERE c_nationkey % 3 = 1 OR (c_nationkey % 3 = 0 AND c_custkey % 20 = 1) GROUP BY 1""",
    "default_types": "SELECT unnest(['appartement', 'maison']) AS type_bien",
    "failed_gate": _with("communes", f"""
        SELECT code_insee, population, '{DS}' AS dt, population AS dans_mart FROM communes"""),
    "colour_of_every_sale": _with("sales", f"""
        SELECT rouge, vert, bleu, opacite, count(*) AS n
        FROM (SELECT {_colour('prix_m2', '200', '40000', V.PALETTE_PRICE)} FROM sales) GROUP BY ALL"""),
    "dim_union_first_wins": """
        , lists AS (
          SELECT 0 AS source, CAST(s_suppkey AS VARCHAR) AS code, s_name AS nom, s_nationkey AS place, 'S' AS region,
            s_suppkey * 10 AS people FROM supplier
          UNION ALL SELECT 1, CAST(c_custkey AS VARCHAR), c_name, c_nationkey, 'C', c_custkey * 10 FROM customer)
        SELECT code AS code_insee, nom, CAST(place AS VARCHAR) AS departement, region,
          CASE WHEN place <> 7 THEN people END AS population
        FROM lists QUALIFY row_number() OVER (PARTITION BY code ORDER BY source) = 1""".replace(
        ", lists", "WITH lists", 1),
    "geo_payload": f"""
        WITH {_PAYLOADS}
        SELECT code AS code_insee, nom, latitude, longitude, contour AS geometry_json, '{V.GEO_SOURCE}' AS source
        FROM payloads""",
    "geo_by_codes": f"""
        WITH {_PAYLOADS}, {_CENTRES}
        SELECT * FROM (
          SELECT code AS code_insee, nom, latitude, longitude, contour AS geometry_json, '{V.GEO_SOURCE}' AS source
          FROM payloads WHERE code IN (SELECT code_insee FROM centres)
          UNION ALL SELECT *, NULL, '{V.GEO_FALLBACK}' FROM centres
          WHERE code_insee NOT IN (SELECT code FROM payloads))
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    "geo_priority_union": f"""
        WITH {_PAYLOADS}, {_CENTRES}, listed AS (SELECT * FROM payloads WHERE s_nationkey < 10),
        single AS (SELECT * FROM payloads WHERE s_nationkey >= 10 AND code IN (SELECT code_insee FROM centres))
        SELECT * FROM (
          SELECT code AS code_insee, nom, latitude, longitude, CAST(NULL AS VARCHAR) AS geometry_json,
            '{V.GEO_SOURCE}' AS source FROM (FROM listed UNION ALL FROM single)
          UNION ALL SELECT *, NULL, '{V.GEO_FALLBACK}' FROM centres
          WHERE code_insee NOT IN (SELECT code FROM payloads))
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    "page_flatten": """
        SELECT conv_id, turn // 4 AS page, turn, role, text FROM conversations""",
    "first_pages": "SELECT conv_id, turn, role FROM conversations WHERE turn < 4",
    "cursor_parse": """
        SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS curseur FROM pages""",
    "page_set_status": """
        SELECT l_orderkey AS dep, count(*) AS pages, coalesce(min(l_linenumber) FILTER (l_returnflag = 'R')
          = max(l_linenumber) AND count(*) = max(l_linenumber), false) AS complete
        FROM lineitem GROUP BY l_orderkey""",
    "source_filter": f"""
        SELECT l_linestatus AS dep, '00007' AS code_insee_ban, count(*) AS n FROM {_LINES}
        WHERE l_linestatus = 'F' AND l_suppkey = 7 AND l_quantity <> 13 GROUP BY l_linestatus""",
    "scoped_partitions": """
        SELECT o_orderkey, o_orderstatus AS dep FROM orders WHERE o_orderstatus IN ('F', 'O')""",
    "union_by_name_scan": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id,
          CAST(user_id AS VARCHAR) AS user_id,
          CASE WHEN event_type <> 'error' THEN CAST(value AS VARCHAR) END AS value, '{DS}' AS dt,
          CASE WHEN event_type IN ('click', 'view') THEN '01' WHEN event_type = 'error' THEN '2A' ELSE '33' END AS dep
        FROM events""",
    "tolerant_csv_scan": """
        SELECT CAST(c_custkey AS VARCHAR) AS code_commune, c_name || ', "' || c_mktsegment || '"' AS adresse,
          lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS code
        FROM customer WHERE c_nationkey NOT IN (3, 5)""",
    "json_array_scan": """
        SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS nom, CAST(n_regionkey AS VARCHAR) AS "codeRegion"
        FROM nation""",
    "partition_scan": "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1997",
    "partition_replace": """
        SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS dt FROM events
        WHERE CAST(ts AS DATE) <> DATE '2024-01-04' AND (CAST(ts AS DATE) <> DATE '2024-01-03' OR event_type = 'error')""",
    "interrupted_replace": """
        SELECT dt, count(*) AS n, sum(o_orderkey)::BIGINT AS cles FROM (
          SELECT o_orderkey, o_orderstatus AS dt FROM orders
          WHERE o_orderstatus = 'P' OR (o_orderstatus IN ('F', 'O') AND o_orderkey % 2 = 1)
          UNION ALL SELECT o_orderkey, 'X' FROM orders WHERE o_orderkey <= 10) GROUP BY dt""",
    "page_chains": """
        WITH pages AS (
          SELECT 'o' || l_orderkey AS dep, l_linenumber AS place, l_returnflag <> 'R' AS goes_on FROM lineitem
          UNION ALL SELECT 'customers', c_custkey + 1, c_custkey < (SELECT max(c_custkey) FROM customer) FROM customer
        ), nodes AS (
          SELECT dep, place, count(DISTINCT goes_on) > 1 AS branches, bool_or(NOT goes_on) AS may_end, bool_or(goes_on) AS may_go
          FROM pages GROUP BY dep, place
        ), ranked AS (
          SELECT *, row_number() OVER (PARTITION BY dep ORDER BY place) AS rank,
            coalesce(count_if(NOT may_go) OVER (PARTITION BY dep ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended
          FROM nodes
        ), sets AS (
          SELECT dep, count(*) AS pages, count_if(rank = place AND ended = 0) AS reached, bool_or(branches) AS branched,
            max(CASE WHEN rank = place AND ended = 0 THEN place END) AS stop FROM ranked GROUP BY dep
        )
        SELECT sets.dep, pages, reached, CASE WHEN may_go THEN (stop + 1)::VARCHAR END AS missing,
          reached = pages AND NOT coalesce(may_go, false) AND NOT branched AS complete
        FROM sets LEFT JOIN nodes ON nodes.dep = sets.dep AND nodes.place = stop""",
    "scope_errors": """
        SELECT perimetre, nullif((SELECT count(*) FROM orders
          WHERE list_contains(list_transform(string_split(perimetre, ','), lambda s: trim(s)), o_orderstatus)), 0) AS lignes
        FROM (VALUES ('F, Z'), ('Z'), (''), ('O,P')) AS v(perimetre)""",
    "business_dates": f"""
        SELECT 'donnee' AS source, '{DS}' AS jour
        UNION ALL SELECT 'amont', strftime(max(ts), '%Y-%m-%d') FROM events""",
    "written_codecs": "SELECT unnest(['raw', 'table']) AS zone, 'ZSTD' AS codec",
    "additive_parts": """
        SELECT o_orderstatus AS dep, count(*) AS lignes, true AS parts_bornees FROM orders
        WHERE o_orderstatus <> 'F' OR o_orderpriority = '1-URGENT' GROUP BY o_orderstatus""",
    "run_metrics": """
        SELECT coalesce(o_orderstatus, 'total') AS dep, count(*) AS lignes FROM orders
        GROUP BY ROLLUP (o_orderstatus)""",
    "exact_sample": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY md5('7|' || o_orderkey) LIMIT 500""",
    "snapshot_export": _with("mart mart_type scored sales communes fact", f"""
        SELECT 'mart_commune' AS nom, count(*) AS lignes FROM mart
        UNION ALL SELECT 'mart_commune_type', count(*) FROM mart_type
        UNION ALL SELECT 'mart_opportunites', count(*) FROM scored
        UNION ALL SELECT 'dvf_stats_commune_type', count(*) FROM ({_SPREAD})
        UNION ALL SELECT 'fact_biens', least(2000, count(*)) FROM fact"""),
    "daily_run": _with("run_scored", "SELECT * FROM run_scored"),
    "incremental_marts": _with("run_scored", "SELECT * FROM run_scored"),
    "stream_refresh": _with("typed_certs", """
        SELECT CASE WHEN etiquette_ges = 'F' THEN '2026-06-17' ELSE dt END AS dt, etiquette_dpe, count(*) AS n,
          count(surface_habitable) AS n_surface
        FROM (SELECT *, row_number() OVER (PARTITION BY etiquette_ges = 'F', numero_dpe ORDER BY
            date_etablissement DESC NULLS LAST, code_insee DESC NULLS LAST,
            code_postal DESC NULLS LAST, nom_commune DESC NULLS LAST, type_batiment DESC NULLS LAST,
            surface_habitable DESC NULLS LAST) AS place FROM typed_certs)
        WHERE place = 1 GROUP BY ALL"""),
}
ORACLE = {
    # Parts that continue a WITH list start with a comma in the text above.
    name: text.replace(")\n\n        , ", "),\n") for name, text in ORACLE.items()
}
