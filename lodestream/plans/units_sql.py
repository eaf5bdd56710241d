"""DuckDB SQL for amounts of pay, by replacement of phrases, independent of the automaton it checks."""

from __future__ import annotations

_WORDS = "twenty nineteen eighteen seventeen sixteen fifteen fourteen thirteen twelve eleven ten nine eight seven six five four three two one".split()
_SCALE = r"(k|thousand|lakhs?|lacs?|lpa|l\.p\.a|l|crore|cr)"
_NUMBER = "[0-9](?:[0-9.,]*[0-9])?"


def _parsed(field: str) -> str:
    """A subquery (job_id, cur, per, a, b, sa, sb) of the amounts that a field states."""
    text = f"lower(trim({field}))"
    text = rf"regexp_replace({text}, '\(incl\. [0-9]+% variable\)|\([0-9]+ positions\)|for [0-9]+\+ yrs|/-', ' ', 'g')"
    for k, w in enumerate(_WORDS):
        text = rf"regexp_replace({text}, '\b{w}\b', '{20 - k}', 'g')"
    after = rf" ?(?:/-)? ?{_SCALE}(?:[^a-z]|$)"
    return f"""SELECT job_id, budget_currency, t, n[1] AS a, coalesce(n[2], n[1]) AS b, n[2] IS NOT NULL AS two,
        CASE WHEN regexp_matches(t, 's\\$|sgd|singapore') THEN 'SGD' WHEN regexp_matches(t, '\\$|usd|dollar') THEN 'USD' WHEN regexp_matches(t, '€|eur') THEN 'EUR' WHEN regexp_matches(t, '£|gbp|pound') THEN 'GBP' WHEN regexp_matches(t, '₹|\\brs\\b|inr|rupee') THEN 'INR' END AS cur,
        CASE WHEN regexp_matches(t, 'p/h|/hr|hour') THEN 'hour' WHEN regexp_matches(t, 'p/d|/day|per day|daily') THEN 'day' WHEN regexp_matches(t, 'p\\.m|\\bpm\\b|mth|month') THEN 'month' WHEN regexp_matches(t, 'lpa|l\\.p\\.a|p\\.a|\\bpa\\b|annum|annual|year|/ ?yr|\\byr\\b') THEN 'year' END AS per,
        nullif(regexp_extract(t, '^[^0-9]*{_NUMBER}{after}', 1), '') AS sa, nullif(regexp_extract(t, '^[^0-9]*{_NUMBER}[^0-9]+{_NUMBER}{after}', 1), '') AS sb
        FROM (SELECT *, regexp_extract_all(t, '{_NUMBER}') AS n FROM (SELECT job_id, budget_currency, {text} AS t FROM d))
        WHERE len(n) > 0 AND NOT regexp_matches(t, '% hike|experience [0-9]+-[0-9]+ yrs|rate card|level [0-9]+ band')"""


def _amounts(field: str, default: str) -> str:
    scale = lambda s: f"CASE WHEN {s} IN ('k', 'thousand') THEN 1000 WHEN {s} IN ('crore', 'cr') THEN 10000000 WHEN {s} IS NOT NULL THEN 100000 END"
    value = lambda v, s: f"(CASE WHEN c = 'EUR' AND {s} IS NULL AND regexp_matches({v}, '^[1-9][0-9]{{0,2}}\\.[0-9]{{3}}$') THEN replace({v}, '.', '') ELSE replace({v}, ',', '') END)::DECIMAL(20, 6)"
    return f"""SELECT job_id, round({value('a', 's1')} * coalesce({scale('s1')}, CASE WHEN bare AND {value('a', 's1')} < 1000 THEN 100000 END, 1) * f.factor * p.factor)::BIGINT AS lo,
        round({value('b', 's2')} * coalesce({scale('s2')}, CASE WHEN bare AND {value('b', 's2')} < 1000 THEN 100000 END, 1) * f.factor * p.factor)::BIGINT AS hi
        FROM (SELECT *, CASE WHEN two THEN coalesce(sa, sb) ELSE sa END AS s1, CASE WHEN two THEN sb ELSE sa END AS s2, coalesce(per, '{default}') AS q,
            coalesce(cur, CASE WHEN lower(budget_currency) IN ('usd', '$', 'us dollar') THEN 'USD' WHEN lower(budget_currency) IN ('eur', '€', 'euro') THEN 'EUR' WHEN lower(budget_currency) IN ('gbp', '£') THEN 'GBP' WHEN lower(budget_currency) IN ('sgd', 's$') THEN 'SGD' END, 'INR') AS c,
            cur IS NULL AND per IS NULL AND sa IS NULL AND sb IS NULL AND coalesce(lower(budget_currency), '') NOT IN ('usd', '$', 'us dollar', 'eur', '€', 'euro', 'gbp', '£', 'sgd', 's$') AS bare FROM ({_parsed(field)}))
        JOIN budget_units f ON f.unit_kind = 'currency' AND f.unit_code = c JOIN budget_units p ON p.unit_kind = 'period' AND p.unit_code = q"""


P1_SQL = f"""WITH d AS (SELECT DISTINCT job_id, yearly_budget, monthly_budget, budget_currency FROM final_corrected_requirements WHERE job_id IS NOT NULL), y AS ({_amounts('yearly_budget', 'year')}), m AS ({_amounts('monthly_budget', 'month')})
    SELECT job_id, least(lo, hi) AS inr_per_year_min, greatest(lo, hi) AS inr_per_year_max FROM (SELECT * FROM y UNION ALL SELECT * FROM m WHERE job_id NOT IN (SELECT job_id FROM y))"""
