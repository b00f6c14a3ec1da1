"""The mixture of the invented corpus: domains by source, target weights, and the same in SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOMAINS = {"web": [f"src{i}" for i in range(10)], "reference": [f"src{i}" for i in range(10, 15)]}
OTHER_DOMAIN = "forum"
WEIGHTS = {
    ("web",): 5,
    ("reference",): 3,
    ("forum",): 2,
    ("*", "en"): 4,
    ("*", "de"): 2,
    ("*", "fr"): 2,
    ("*", "es"): 1,
    ("forum", "en"): 3,
    ("*", "*", "src0"): 3,
    ("reference", "en", "src11"): 2,
}
SHARE = (3, 5)
MAX_EPOCHS = 2
SEED = 17


def domain(source: str = "source") -> Column:
    out = F.when(F.col(source).isin(DOMAINS["web"]), "web").when(F.col(source).isin(DOMAINS["reference"]), "reference")
    return out.otherwise(OTHER_DOMAIN)


def _sql_level(parents: str, name: str, path: str) -> str:
    """Budgets of one level: the children of every parent filled from the smallest capacity per weight."""
    over = f"PARTITION BY {parents}" if parents else ""
    return f"""
      SELECT {path}, CASE WHEN NOT good THEN 0 WHEN "full" THEN capacity
             ELSE (budget - sum(CASE WHEN "full" THEN capacity ELSE 0 END) OVER ({over})) * weight
                  // nullif(sum(CASE WHEN "full" OR NOT good THEN 0 ELSE weight END) OVER ({over}), 0) END AS budget
      FROM (SELECT *, good AND capacity * (sum(CASE WHEN good THEN weight ELSE 0 END) OVER ({over}) - weight_before)
                           <= (budget - capacity_before) * weight AS "full"
            FROM (SELECT *, coalesce(sum(CASE WHEN good THEN weight ELSE 0 END) OVER before, 0) AS weight_before,
                         coalesce(sum(CASE WHEN good THEN capacity ELSE 0 END) OVER before, 0) AS capacity_before
                  FROM (SELECT *, weight > 0 AND capacity > 0 AS good,
                               CASE WHEN weight > 0 AND capacity > 0 THEN capacity::DOUBLE / weight::DOUBLE END AS ratio FROM nodes_{name})
                  WINDOW before AS ({over} ORDER BY ratio NULLS FIRST, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))"""


def mix_sql(documents: str, share: tuple[int, int], columns: str) -> str:
    """DuckDB SQL of the mixed rows of a table: alias d has its columns, n_tokens, domain; `epoch` is the copy."""
    web, reference = (", ".join(f"'{s}'" for s in DOMAINS[k]) for k in ("web", "reference"))
    return f"""
    WITH placed AS (
      SELECT *, CASE WHEN source IN ({web}) THEN 'web' WHEN source IN ({reference}) THEN 'reference' ELSE 'forum' END AS domain,
             coalesce(lang, '(none)') AS l, coalesce(source, '(none)') AS s,
             coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens
      FROM {documents}),
    leaves AS (SELECT domain, l AS lang, s AS source, sum(n_tokens)::HUGEINT AS supply FROM placed GROUP BY ALL),
    weighted AS (
      SELECT *, supply * {MAX_EPOCHS} AS capacity,
             CASE domain WHEN 'web' THEN 5 WHEN 'reference' THEN 3 ELSE 2 END AS domain_weight,
             CASE WHEN domain = 'forum' AND lang = 'en' THEN 3
                  ELSE CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END END AS lang_weight,
             CASE WHEN domain = 'reference' AND lang = 'en' AND source = 'src11' THEN 2 WHEN source = 'src0' THEN 3 ELSE 1 END AS source_weight
      FROM leaves),
    nodes_domain AS (
      SELECT domain, sum(capacity)::HUGEINT AS capacity, any_value(domain_weight)::HUGEINT AS weight,
             (SELECT least(sum(capacity), sum(supply) * {share[0]} // {share[1]}) FROM weighted)::HUGEINT AS budget
      FROM weighted GROUP BY domain),
    given_domain AS ({_sql_level("", "domain", "domain")}),
    nodes_lang AS (
      SELECT w.domain, w.lang, sum(capacity)::HUGEINT AS capacity, any_value(lang_weight)::HUGEINT AS weight, any_value(g.budget)::HUGEINT AS budget
      FROM weighted w JOIN given_domain g USING (domain) GROUP BY ALL),
    given_lang AS ({_sql_level("domain", "lang", "domain, lang")}),
    nodes_source AS (
      SELECT w.domain, w.lang, w.source, capacity, source_weight::HUGEINT AS weight, g.budget::HUGEINT AS budget
      FROM weighted w JOIN given_lang g USING (domain, lang)),
    given_source AS ({_sql_level("domain, lang", "source", "domain, lang, source")}),
    planned AS (
      SELECT domain, lang, source, coalesce(budget // nullif(supply, 0), 0)::BIGINT AS epochs,
             budget - coalesce(budget // nullif(supply, 0), 0) * supply AS rest
      FROM leaves JOIN given_source USING (domain, lang, source)),
    ordered AS (
      SELECT d.*, epochs, rest, coalesce(sum(n_tokens) OVER (PARTITION BY d.domain, d.l, d.s ORDER BY md5(concat_ws(':', '{SEED}', epochs::VARCHAR, doc_id::VARCHAR))
             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS tokens_before
      FROM placed d JOIN planned p ON d.domain = p.domain AND d.l = p.lang AND d.s = p.source)
    SELECT {columns}
    FROM (SELECT *, unnest(range(epochs + CASE WHEN tokens_before < rest THEN 1 ELSE 0 END)) AS epoch FROM ordered) d"""
