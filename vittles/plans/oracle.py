"""DuckDB forms of the bound queries (the driver's correctness oracle).

Written independently of the Spark code, constants included: plain SQL over the
pre-registered views.  Float outputs are rounded to 6 decimals, as on the Spark side.
"""

from __future__ import annotations

# Fixed values, stated here apart from the code under test: what the queries ask for
# (measures, units, patterns, requests, limits) and the names and factors of the domain.
BAD_AMOUNT_TEXT = {'error': 'n/a', 'view': ''}
BASE_FEATURE_MAP = [('protein_g', 'protein_g_per100g'), ('fiber_g', 'fiber_g_per100g'), ('potassium_mg', 'potassium_mg_per100g'),
 ('added_sugar_g', 'added_sugar_g_per100g'), ('sugar_g', 'sugar_g_per100g'), ('sodium_mg', 'sodium_mg_per100g'),
 ('sat_fat_g', 'sat_fat_g_per100g'), ('total_fat_g', 'total_fat_g_per100g'), ('carbs_g', 'carbs_g_per100g'),
 ('energy_kcal', 'energy_kcal_per100g'), ('mono_fat_g', 'mono_fat_g_per100g'), ('poly_fat_g', 'poly_fat_g_per100g')]
DRIVER_COEFS = {'protein_g_per100g': 0.8,
 'fiber_g_per100g': 0.6,
 'potassium_mg_per100g': 0.3,
 'sugar_g_per100g': -0.4,
 'sodium_mg_per100g': -0.5,
 'sat_fat_g_per100g': -0.7,
 'energy_kcal_per100g': -0.2}
EVENT_TYPES = ['click', 'error', 'purchase', 'signup', 'view', 'refund']
EVENT_UNITS = {'click': 'mg', 'error': 'MCG', 'purchase': ' g ', 'signup': 'kJ', 'view': 'oz'}
LINEITEM_STAT_COLS = ['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']
MIN_FEATURES = 6
NEIGHBOUR_FEATURES = ['protein_g_per100g', 'fiber_g_per100g', 'potassium_mg_per100g', 'added_sugar_g_per100g', 'sugar_g_per100g',
 'sodium_mg_per100g', 'sat_fat_g_per100g', 'total_fat_g_per100g', 'carbs_g_per100g', 'energy_kcal_per100g',
 'mono_fat_g_per100g', 'poly_fat_g_per100g']
N_NEIGHBOURS = 50
N_SUBSTITUTES = 5
OVERRIDE_BRAND = 'Brand#13'
PART_FORM_KEYWORDS = ['old', 'ring', 'izm', 'promo']
PART_KEYWORD_GROUPS = {'anvils': '\\banvil', 'bolts': 'bolt', 'hot_or_cold': '^(hot|cold) ', 'gizmo_widget': 'gizmo|widget'}
PART_PATTERNS = [('gear_mg', 'mg', ['\\bcogs?\\b', '\\bgears?\\b']), ('bolt_g', 'g', ['^(blue|red) bolt$', 'bolt']),
 ('rod_kcal', 'kcal', ['\\bhot\\b.*\\brod\\b']), ('plate_ug', 'ug', ['plate']),
 ('ring_g', 'g', ['^(small|large)\\s+ring$']), ('gizmo_kj', 'kj', ['GIZMO', 'widget']),
 ('spring_g', 'g', ['\\bsprings?\\b'])]
PART_TYPE_UNITS = {'ECONOMY': 'mg', 'STANDARD': ' MCG ', 'LARGE': 'g', 'SMALL': 'kJ', 'PROMO': 'kcal', 'MEDIUM': 'IU'}
RANKED_QUERIES = ['blue bolt', 'gear', 'zzqx', 'b', 'old rod']
SEARCH_LIMIT = 20
SERVING_WEIGHT_PER_SIZE = 10
TOKEN_QUERIES = ['blue bolt', 'Brand#1 gear', 'cold xyz', 'HOT', '   ']
URGENT = '1-URGENT'
LINEITEM_MEASURES = [('protein_g', 'l_quantity'), ('fiber_g', 'floor(l_discount * 300 + 0.5)'),
 ('potassium_mg', 'floor(l_extendedprice / 10 + 0.5)'), ('sodium_mg', 'floor(l_extendedprice / 400 + 0.5)'),
 ('sat_fat_g', 'floor(l_tax * 25 + 0.5)'), ('sugar_g', 'l_quantity / 16'),
 ('energy_kcal', 'floor(l_extendedprice / 1000 + 0.5)')]
SERVING_SIZE_LIMIT = 45
CANONICAL_ORDER = ['energy_kcal', 'protein_g', 'total_fat_g', 'sat_fat_g', 'mono_fat_g', 'poly_fat_g', 'carbs_g', 'fiber_g', 'sugar_g',
 'added_sugar_g', 'sodium_mg', 'potassium_mg']
CONVERSION_FACTORS = {('ug', 'mg'): 0.001,
 ('ug', 'g'): 1e-06,
 ('mg', 'g'): 0.001,
 ('mg', 'ug'): 1000.0,
 ('g', 'mg'): 1000.0,
 ('g', 'ug'): 1000000.0,
 ('kj', 'kcal'): 0.239005736,
 ('kcal', 'kj'): 4.184}
UNIT_SYNONYMS = {'µg': 'ug',
 'μg': 'ug',
 'mcg': 'ug',
 'ug': 'ug',
 'mg': 'mg',
 'g': 'g',
 'kg': 'kg',
 'kcal': 'kcal',
 'calorie': 'kcal',
 'kilocalorie': 'kcal',
 'kj': 'kj',
 'unit': 'unit'}
FRIENDLY_NAMES = {'energy_kcal': 'Calories',
 'protein_g': 'Protein',
 'carbs_g': 'Carbs',
 'fiber_g': 'Fiber',
 'sugar_g': 'Sugar',
 'added_sugar_g': 'Added Sugar',
 'sodium_mg': 'Sodium',
 'sat_fat_g': 'Saturated Fat'}


def _cap(expr: str, ref: float) -> str:
    return f"(CASE WHEN ({expr}) IS NULL THEN NULL ELSE least(greatest(({expr}) / {ref!r} * 100.0, 0.0), 100.0) END)"


def _mean0(parts: list[str]) -> str:
    total = " + ".join(f"coalesce({p}, 0.0)" for p in parts)
    n = " + ".join(f"(CASE WHEN {p} IS NULL THEN 0 ELSE 1 END)" for p in parts)
    return f"coalesce(({total}) / nullif({n}, 0), 0.0)"


def _facts_sql() -> str:
    parts = [f"SELECT l_partkey AS fdc_id, '{n}' AS canonical_name, CAST({e} AS DOUBLE) AS amount FROM lineitem"
             for n, e in LINEITEM_MEASURES]
    return "\n UNION ALL ".join(parts)


def scored_parts_sql() -> str:
    """CTE chain ending in ``scored`` (one row per part)."""
    wide_cols = ",\n    ".join(
        f"CASE WHEN isnan(v) OR isinf(v) THEN NULL ELSE v END AS {n}_per100g".replace(
            "v", f"avg(amount) FILTER (WHERE canonical_name = '{n}')")
        for n in CANONICAL_ORDER)
    per_serv = ",\n    ".join(f"{n}_per100g * (nullif(w, 0) / 100.0) AS {n}_perserving" for n in CANONICAL_ORDER)
    added = ("CASE WHEN coalesce(added_sugar_missing = 1, false) THEN sugar_g_perserving * 0.75 "
             "ELSE added_sugar_g_perserving END")
    macro = _mean0([_cap("protein_g_perserving", 50.0), _cap("fiber_g_perserving", 28.0)])
    micro = _mean0([_cap("potassium_mg_perserving", 4700.0)])
    penalty = _mean0([_cap("added_used", 50.0), _cap("sodium_mg_perserving", 2300.0),
                      _cap("sat_fat_g_perserving", 20.0), _cap("energy_kcal_per100g", 275.0)])
    return f"""
facts AS (
 SELECT DISTINCT fdc_id, canonical_name, amount FROM (
 {_facts_sql()})
),
wide AS (
 SELECT fdc_id,
    {wide_cols}
 FROM facts GROUP BY fdc_id
),
ds AS (
 SELECT p.p_partkey AS fdc_id, p.p_name AS description, p.p_brand AS brand_owner, p.p_type AS food_category,
    p.p_size, p.p_retailprice,
    coalesce(CASE WHEN p.p_size <= {SERVING_SIZE_LIMIT} THEN CAST(p.p_size * {SERVING_WEIGHT_PER_SIZE} AS DOUBLE) END, 100.0) AS w,
    coalesce(CASE WHEN p.p_size <= {SERVING_SIZE_LIMIT} THEN 'size ' || CAST(p.p_size AS VARCHAR) END, '100 g') AS serving_desc,
    wide.* EXCLUDE (fdc_id)
 FROM part p LEFT JOIN wide ON wide.fdc_id = p.p_partkey
),
ps AS (
 SELECT *, w AS serving_gram_weight,
    {per_serv},
    CASE WHEN added_sugar_g_per100g IS NULL THEN 1 ELSE 0 END AS added_sugar_missing
 FROM ds
),
ps2 AS (
 SELECT *, energy_kcal_perserving AS kcal_per_serv, energy_kcal_per100g AS kcal_per100g,
    {added} AS added_used,
    CAST(coalesce(added_sugar_missing = 1, false) AS INTEGER) AS penalty_estimated
 FROM ps
),
parts3 AS (
 SELECT *, {macro} AS macro_score, {micro} AS micro_score, {penalty} AS penalty_score FROM ps2
),
scored0 AS (
 SELECT *, coalesce(least(greatest(0.45 * macro_score + 0.35 * micro_score - 0.2 * penalty_score, 0.0), 100.0), 0.0)
    AS nutrition_score FROM parts3
),
scored AS (
 SELECT *, CASE WHEN nutrition_score >= 85.0 THEN 'A' WHEN nutrition_score >= 75.0 THEN 'B'
    WHEN nutrition_score >= 65.0 THEN 'C' WHEN nutrition_score >= 50.0 THEN 'D' ELSE 'E' END AS grade,
    nutrition_score AS score
 FROM scored0
)"""


SCORED = scored_parts_sql()

Q08 = f"""WITH {SCORED}
SELECT fdc_id, grade, penalty_estimated, serving_desc, round(serving_gram_weight, 6) AS serving_gram_weight,
  round(kcal_per_serv, 6) AS kcal_per_serv, round(macro_score, 6) AS macro_score, round(micro_score, 6) AS micro_score,
  round(penalty_score, 6) AS penalty_score, round(nutrition_score, 6) AS nutrition_score
FROM scored"""


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _norm_unit(expr: str) -> str:
    key = f"lower(trim({expr}))"
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in UNIT_SYNONYMS.items())
    return f"(CASE {key} {whens} ELSE {key} END)"


def _factor(from_norm: str, to_norm: str) -> str:
    """Lenient factor: 1 when equal or source NULL, known pair factor, else NULL."""
    pairs = " ".join(f"WHEN {_q(a + '|' + b)} THEN {v!r}" for (a, b), v in CONVERSION_FACTORS.items())
    return (f"(CASE WHEN {from_norm} IS NULL OR {from_norm} = {to_norm} THEN 1.0 "
            f"ELSE (CASE {from_norm} || '|' || {to_norm} {pairs} END) END)")


def _map_case(expr: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"(CASE {expr} {whens} END)"


NUM_RE = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def _to_double(expr: str) -> str:
    return f"(CASE WHEN regexp_matches(trim({expr}), {_q(NUM_RE)}) THEN TRY_CAST(trim({expr}) AS DOUBLE) END)"


def _to_id(expr: str) -> str:
    d = _to_double(expr)
    return f"(CASE WHEN {d} = floor({d}) THEN CAST({d} AS BIGINT) END)"


Q01 = "SELECT c_custkey, c_name, c_mktsegment AS segment, c_nationkey FROM customer"

Q02 = """SELECT coalesce(CAST(p_partkey AS VARCHAR), '') AS p_partkey, coalesce(p_name, '') AS p_name,
  coalesce(p_brand, '') AS p_brand, coalesce(nullif(p_type, 'PROMO'), '') AS p_type,
  coalesce(CAST(p_size AS VARCHAR), '') AS p_size FROM part"""

_amount_text = "(CASE event_type " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in BAD_AMOUNT_TEXT.items()) \
    + r" ELSE regexp_extract(props, '(\d+)', 1) END)"
Q03 = f"""WITH t AS (
  SELECT event_id, CASE WHEN value < 1.0 THEN '' ELSE CAST(user_id AS VARCHAR) || '.0' END AS user_text,
    {_amount_text} AS amount_text FROM events)
SELECT event_id, {_to_id('user_text')} AS user_id, {_to_double('amount_text')} AS amount
FROM t WHERE {_to_id('user_text')} IS NOT NULL"""

_ev_unit = f"(CASE WHEN value >= 300.0 THEN NULL ELSE {_map_case('event_type', EVENT_UNITS)} END)"
Q04 = f"""WITH u AS (SELECT event_id, value, {_norm_unit(_ev_unit)} AS unit FROM events)
SELECT event_id, unit, round(value * coalesce({_factor('unit', "'mg'")}, 1.0), 6) AS value_mg FROM u"""

_pat_rows = ", ".join(f"({_q(n)}, {i}, {_q(p)}, {j}, {_q(u)})"
                      for i, (n, u, pats) in enumerate(PART_PATTERNS) for j, p in enumerate(pats))
_pairs = ", ".join(_q(a + "|" + b) for (a, b) in CONVERSION_FACTORS)
Q05 = f"""WITH nutr AS (
  SELECT p_partkey AS nutrient_id, trim(p_name) AS nutrient_name,
    {_map_case('p_type', PART_TYPE_UNITS)} AS raw_unit,
    {_norm_unit(_map_case('p_type', PART_TYPE_UNITS))} AS unit,
    CASE WHEN p_size <= {SERVING_SIZE_LIMIT} THEN p_size END AS nbr
  FROM part),
pats(canonical_name, ord, pattern, pattern_ord, target_unit) AS (VALUES {_pat_rows}),
cand AS (
  SELECT canonical_name, pattern_ord, nutrient_id, nutrient_name, coalesce(unit, raw_unit) AS unit_name,
    pattern AS matched_pattern,
    CASE WHEN unit = {_norm_unit('target_unit')} THEN 10
         WHEN unit || '|' || {_norm_unit('target_unit')} IN ({_pairs}) THEN 5 ELSE 0 END AS us,
    coalesce(-CAST(nbr AS BIGINT), 0) AS ns
  FROM nutr JOIN pats ON regexp_matches(nutrient_name, pattern, 'i')),
r AS (SELECT *, row_number() OVER (PARTITION BY canonical_name
        ORDER BY pattern_ord, us DESC, ns DESC, nutrient_id) AS rn FROM cand)
SELECT canonical_name, nutrient_id, nutrient_name, unit_name, matched_pattern FROM r WHERE rn = 1"""

_ev_cols = ",\n  ".join(f"round(avg(value) FILTER (WHERE event_type = {_q(t)}), 6) AS {t}" for t in EVENT_TYPES)
Q06 = f"""WITH d AS (SELECT DISTINCT user_id, event_type, value FROM events
  WHERE event_type IN ({", ".join(_q(t) for t in EVENT_TYPES)}))
SELECT user_id,
  {_ev_cols}
FROM d GROUP BY user_id"""

Q07 = """WITH o AS (
  SELECT o_custkey, o_orderkey, coalesce(nullif(trim(nullif(o_orderpriority, '4-NOT SPECIFIED')), ''), '') AS txt,
    coalesce(o_totalprice, 0.0) AS w FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY CASE WHEN length(txt) > 0 THEN 1 ELSE 0 END DESC, w DESC, o_orderkey) AS rn FROM o)
SELECT o_custkey, txt AS serving_desc, round(w, 6) AS serving_gram_weight FROM r WHERE rn = 1"""

Q09 = f"""WITH {SCORED}
SELECT coalesce(food_category, 'Unknown') AS food_category, coalesce(grade, 'Unknown') AS grade,
  count(*) AS count FROM scored GROUP BY ALL"""

_kw = " OR ".join(f"contains(txt, {_q(k)})" for k in PART_FORM_KEYWORDS)
Q10 = f"""WITH t AS (
  SELECT p_partkey, p_brand, p_size,
    lower(concat_ws(' ', nullif(trim(p_name), ''), nullif(trim(p_type), ''),
                         nullif(trim(nullif(p_brand, 'Brand#1')), ''))) AS txt FROM part)
SELECT p_partkey AS fdc_id,
  coalesce(CASE WHEN p_brand = {_q(OVERRIDE_BRAND)} THEN 'gel' END,
           CASE WHEN {_kw} THEN 'liquid' ELSE 'solid' END) AS form,
  CASE WHEN p_size <= {SERVING_SIZE_LIMIT} THEN 0 ELSE 1 END AS size_missing
FROM t"""


def _rz(c: str, m: str, d: str) -> str:
    return f"(CASE WHEN {d} = 0 OR {d} IS NULL THEN 0.0 ELSE ({c} - {m}) / (1.4826 * {d}) END)"


def _clip(z: str, lo: float, hi: float) -> str:
    return f"(CASE WHEN {z} IS NULL THEN NULL ELSE least(greatest({z}, {lo}), {hi}) END)"


_cols11 = ["p_retailprice", "constant", "size40"]
Q11 = f"""WITH b AS (
  SELECT p_partkey, p_retailprice, CAST(5.0 AS DOUBLE) AS constant,
    CASE WHEN p_size <= 40 THEN CAST(p_size AS DOUBLE) END AS size40 FROM part),
m AS (SELECT {", ".join(f"median({c}) AS m_{c}" for c in _cols11)} FROM b),
d AS (SELECT {", ".join(f"median(abs({c} - m_{c})) AS d_{c}" for c in _cols11)} FROM b, m)
SELECT p_partkey,
  {", ".join(f"round({_rz(c, 'm_' + c, 'd_' + c)}, 6) AS {c}_z" for c in _cols11)},
  {", ".join(f"round({_clip(_rz(c, 'm_' + c, 'd_' + c), -2.5, 2.5)}, 6) AS {c}_z_clipped" for c in _cols11)}
FROM b, m, d"""

_l12 = " UNION ALL ".join(f"SELECT {_q(c)} AS name, CAST({c} AS DOUBLE) AS value FROM lineitem"
                          for c in LINEITEM_STAT_COLS)
Q12 = f"""WITH l AS (SELECT * FROM ({_l12}) WHERE value IS NOT NULL),
s AS (SELECT name, avg(value) AS mean, quantile_cont(value, 0.1) AS p10, quantile_cont(value, 0.9) AS p90,
        median(value) AS median FROM l GROUP BY name),
mad AS (SELECT l.name, median(abs(l.value - s.median)) AS mad FROM l JOIN s ON l.name = s.name GROUP BY l.name)
SELECT s.name AS nutrient, round(mean, 6) AS mean, round(p10, 6) AS p10, round(p90, 6) AS p90,
  round(median, 6) AS median, round(mad, 6) AS mad FROM s JOIN mad ON s.name = mad.name"""

_m13 = [("size_per100g", "CASE WHEN p_size <= 45 THEN p_size END"),
        ("price_per100g", "CASE WHEN p_type <> 'PROMO' THEN p_retailprice END"),
        ("brand_per100g", "nullif(p_brand, 'Brand#1')"),
        ("empty_per100g", "CAST(NULL AS DOUBLE)"),
        ("name_per100g", "p_name")]
Q13 = " UNION ALL ".join(
    f"SELECT {_q(n)} AS \"column\", round(sum(CASE WHEN ({e}) IS NULL THEN 1 ELSE 0 END) / "
    f"CAST(greatest(count(*), 1) AS DOUBLE), 6) AS missing_fraction FROM part" for n, e in _m13)

Q14 = """SELECT coalesce(nullif(c_mktsegment, 'MACHINERY'), 'Unknown') AS food_category,
  coalesce(n_name, 'Unknown') AS wweia_category, count(*) AS count
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"""

_s15 = ("fdc_id, description, grade, round(nutrition_score, 6) AS nutrition_score, round(kcal_per_serv, 6) AS "
        "kcal_per_serv, round(sodium_mg_perserving, 6) AS sodium_mg_perserving, round(sugar_g_perserving, 6) AS "
        "sugar_g_perserving")
Q15 = f"""WITH {SCORED}
(SELECT 'top' AS rank_type, {_s15} FROM scored ORDER BY nutrition_score DESC, fdc_id LIMIT 50)
UNION ALL
(SELECT 'bottom' AS rank_type, {_s15} FROM scored ORDER BY nutrition_score ASC, fdc_id LIMIT 50)"""

Q16 = f"""WITH {SCORED}
SELECT count(*) AS n_foods, CAST(count_if(sodium_mg_per100g <= 140.0) AS BIGINT) AS low_sodium,
  CAST(count_if(fiber_g_per100g >= 5.0) AS BIGINT) AS high_fiber,
  round(avg(score), 6) AS avg_score, round(min(score), 6) AS min_score, round(max(score), 6) AS max_score,
  round(avg(CASE WHEN grade IN ('A', 'B') THEN 1.0 ELSE 0.0 END) * 100.0, 6) AS ab_share_pct
FROM scored"""



# Features of the part binding that carry data (the measured nutrients), in index order.
_measured = {n for n, _ in LINEITEM_MEASURES}
FEATS = [f for f in NEIGHBOUR_FEATURES if f.replace("_per100g", "") in _measured]
_nn = " + ".join(f"(CASE WHEN {f} IS NULL THEN 0 ELSE 1 END)" for f in FEATS)
_qs = ", ".join(f"quantile_cont({f}, 0.25) AS q1_{f}, median({f}) AS m_{f}, quantile_cont({f}, 0.75) AS q3_{f}"
                for f in FEATS)


def _scaled(f: str) -> str:
    iqr = f"(CASE WHEN q3_{f} - q1_{f} = 0 THEN 1.0 ELSE q3_{f} - q1_{f} END)"
    x = f"(({f} - m_{f}) / {iqr})"
    return f"coalesce(CASE WHEN isnan({x}) OR isinf({x}) THEN NULL ELSE {x} END, 0.0)"


SCALED = f"""{SCORED},
el AS (SELECT * FROM scored WHERE serving_gram_weight IS NOT NULL AND ({_nn}) >= {MIN_FEATURES}),
qs AS (SELECT {_qs} FROM el),
sc AS (SELECT fdc_id, score, {", ".join(f"{_scaled(f)} AS {f}_scaled" for f in FEATS)} FROM el, qs)"""

Q17 = f"""WITH {SCALED}
SELECT fdc_id, {", ".join(f"round({f}_scaled, 6) AS {f}_scaled" for f in FEATS)} FROM sc"""


def _unit(v: str) -> str:
    nrm = f"sqrt(list_sum(list_transform({v}, lambda x: x * x)))"
    return (f"(CASE WHEN {nrm} > 0 THEN list_transform({v}, lambda x: x / {nrm}) "
            f"ELSE list_transform({v}, lambda x: 0.0) END)")


Q18 = f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT vec_id, {_unit('v')} AS u FROM e),
p AS (SELECT a.vec_id, b.vec_id AS neighbor_id, list_dot_product(a.u, b.u) AS sim
      FROM u a JOIN u b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, neighbor_id) AS rn FROM p)
SELECT vec_id, neighbor_id, round(sim, 6) AS cos_sim FROM r WHERE rn <= 10"""

EDGES = f"""{SCALED},
vec AS (SELECT fdc_id, score, {_unit("[" + ", ".join(f"{f}_scaled" for f in FEATS) + "]")} AS u FROM sc),
pairs AS (SELECT a.fdc_id, b.fdc_id AS neighbor_id, list_dot_product(a.u, b.u) AS cos_sim, a.score AS base_score
          FROM vec a JOIN vec b ON a.fdc_id <> b.fdc_id),
edges AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fdc_id ORDER BY cos_sim DESC, neighbor_id) AS rn
          FROM pairs) WHERE rn <= {N_NEIGHBOURS})"""

_kw19 = " OR ".join(f"contains(txt, {_q(k)})" for k in PART_FORM_KEYWORDS)
FOODS19 = f"""{EDGES},
ft AS (SELECT *, lower(concat_ws(' ', nullif(trim(description), ''), nullif(trim(food_category), ''),
                 nullif(trim(nullif(brand_owner, 'Brand#1')), ''))) AS txt FROM scored),
foods AS (SELECT fdc_id, score, grade, food_category AS grp, kcal_per_serv AS kcal, sodium_mg_perserving AS sodium,
   coalesce(CASE WHEN brand_owner = {_q(OVERRIDE_BRAND)} THEN 'gel' END,
            CASE WHEN {_kw19} THEN 'liquid' ELSE 'solid' END) AS form FROM ft)"""


def _hi(x: str) -> str:
    return f"CAST(round_even({x}, 0) AS BIGINT)"


BEST19 = f"""{FOODS19},
t1 AS (
  SELECT e.fdc_id, e.neighbor_id, c.score, c.score - b.score AS score_gain, c.grade,
    concat_ws(', ', 'score +' || CAST({_hi('c.score - b.score')} AS VARCHAR),
      CASE WHEN c.sodium IS NOT NULL THEN 'sodium ' || CAST({_hi('c.sodium')} AS VARCHAR) || 'mg' END,
      CASE WHEN c.kcal IS NOT NULL THEN 'kcal ' || CAST({_hi('c.kcal')} AS VARCHAR) END) AS why,
    1 AS tier,
    CAST(row_number() OVER (PARTITION BY e.fdc_id ORDER BY 0.6 * e.cos_sim + 0.4 * ((c.score - b.score) / 100.0) DESC,
                       e.neighbor_id) AS INTEGER) AS rank
  FROM edges e JOIN foods b ON b.fdc_id = e.fdc_id LEFT JOIN foods c ON c.fdc_id = e.neighbor_id
  WHERE coalesce((b.form IS NULL OR c.form = b.form) AND (b.grp IS NULL OR c.grp = b.grp)
    AND (b.kcal IS NULL OR abs(c.kcal - b.kcal) <= 100.0) AND c.sodium <= 500.0
    AND c.score - b.score >= 10.0, false)),
t2 AS (
  SELECT b.fdc_id, c.fdc_id AS neighbor_id, c.score, c.score - b.score AS score_gain, c.grade,
    'score +' || CAST(greatest(0, {_hi('c.score - b.score')}) AS VARCHAR) AS why, 2 AS tier,
    CAST(row_number() OVER (PARTITION BY b.fdc_id ORDER BY c.score DESC, c.fdc_id) AS INTEGER) AS rank
  FROM foods b JOIN foods c ON (b.form IS NULL OR c.form = b.form) AND (b.grp IS NULL OR c.grp = b.grp)
    AND c.score > b.score AND c.score >= b.score + 10.0),
t3 AS (
  SELECT b.fdc_id, c.fdc_id AS neighbor_id, c.score, c.score - b.score AS score_gain, c.grade,
    'score +' || CAST(greatest(0, {_hi('c.score - b.score')}) AS VARCHAR) AS why, 3 AS tier,
    CAST(row_number() OVER (PARTITION BY b.fdc_id ORDER BY c.score DESC, c.fdc_id) AS INTEGER) AS rank
  FROM foods b JOIN foods c ON c.score >= b.score + 10.0),
allt AS (SELECT * FROM t1 WHERE rank <= {N_SUBSTITUTES} UNION ALL SELECT * FROM t2 WHERE rank <= {N_SUBSTITUTES}
         UNION ALL SELECT * FROM t3 WHERE rank <= {N_SUBSTITUTES}),
best AS (SELECT *, min(tier) OVER (PARTITION BY fdc_id) AS bt FROM allt)"""

Q19 = f"""WITH {BEST19}
SELECT fdc_id, neighbor_id, round(score, 6) AS score, round(score_gain, 6) AS score_gain, grade, why, tier, rank
FROM best WHERE tier = bt"""

Q20 = f"""WITH {EDGES},
cand AS (SELECT fdc_id FROM scored WHERE grade IN ('D', 'E')),
sub AS (SELECT e.fdc_id, s.score - e.base_score AS gain FROM edges e JOIN cand ON e.fdc_id = cand.fdc_id
        LEFT JOIN scored s ON s.fdc_id = e.neighbor_id),
cov AS (SELECT count(DISTINCT fdc_id) AS covered FROM sub WHERE gain >= 10.0),
tot AS (SELECT count(*) AS total FROM cand)
SELECT covered, total, round(covered / greatest(total, 1), 6) AS coverage FROM cov, tot"""



FORMED = f"""{SCORED},
ftx AS (SELECT *, lower(concat_ws(' ', nullif(trim(description), ''), nullif(trim(food_category), ''),
                 nullif(trim(nullif(brand_owner, 'Brand#1')), ''))) AS txt FROM scored),
formed AS (SELECT * EXCLUDE (txt), coalesce(CASE WHEN brand_owner = {_q(OVERRIDE_BRAND)} THEN 'gel' END,
            CASE WHEN {_kw19} THEN 'liquid' ELSE 'solid' END) AS form FROM ftx)"""


def _req(queries: list[str]) -> str:
    return "req(query_id, q) AS (VALUES " + ", ".join(f"({i + 1}, {_q(x)})" for i, x in enumerate(queries)) + ")"


Q21 = f"""WITH {FORMED},
{_req(TOKEN_QUERIES)},
tk AS (SELECT query_id, list_filter(string_split_regex(lower(q), '\\s+'), lambda x: x <> '') AS toks FROM req),
tok AS (SELECT query_id, unnest(toks) AS tok, unnest(generate_series(0, len(toks) - 1)) AS pos, len(toks) AS ntok
        FROM tk WHERE len(toks) > 0),
m AS (SELECT t.query_id, f.fdc_id, t.pos, t.ntok FROM formed f JOIN tok t
      ON contains(lower(coalesce(f.description, '')), t.tok) OR contains(lower(coalesce(f.brand_owner, '')), t.tok)),
per AS (SELECT query_id, fdc_id, count(DISTINCT pos) = max(ntok) AS all_hit,
          max(CASE WHEN pos = 0 THEN 1 ELSE 0 END) AS first_hit FROM m GROUP BY query_id, fdc_id),
qa AS (SELECT query_id, max(CASE WHEN all_hit THEN 1 ELSE 0 END) AS any_all FROM per GROUP BY query_id),
ch AS (SELECT per.* FROM per JOIN qa ON per.query_id = qa.query_id
       WHERE CASE WHEN any_all = 1 THEN all_hit ELSE first_hit = 1 END),
r AS (SELECT query_id, fdc_id FROM ch)
SELECT CAST(r.query_id AS BIGINT) AS query_id, r.fdc_id, f.description, f.brand_owner
FROM r JOIN formed f ON r.fdc_id = f.fdc_id"""

_coarse = ("(contains(lower(coalesce(f.description, '')), fl.ql) OR "
           "contains(lower(coalesce(f.food_category, '')), fl.ql))")
_lev = ("1.0 - levenshtein(fl.ql, lower(coalesce(f.description, ''))) / "
        "CAST(greatest(length(fl.ql), length(lower(coalesce(f.description, ''))), 1) AS DOUBLE)")
Q22 = f"""WITH {FORMED},
{_req(RANKED_QUERIES)},
r AS (SELECT query_id, lower(q) AS ql, length(q) < 2 AS short FROM req),
lq AS (SELECT * FROM r WHERE NOT short),
hits AS (SELECT fl.query_id, count(*) AS n FROM formed f JOIN lq fl ON {_coarse} GROUP BY fl.query_id),
fl AS (SELECT lq.*, coalesce(hits.n, 0) = 0 AS none FROM lq LEFT JOIN hits ON lq.query_id = hits.query_id),
cand AS (SELECT fl.query_id, f.*, {_lev} AS match_score FROM formed f JOIN fl ON {_coarse} OR fl.none),
rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY match_score DESC, nutrition_score DESC, fdc_id)
       AS rank FROM cand),
best AS (SELECT *, row_number() OVER (ORDER BY nutrition_score DESC, fdc_id) AS rank FROM formed
         ORDER BY nutrition_score DESC, fdc_id LIMIT {SEARCH_LIMIT}),
sh AS (SELECT r.query_id, best.fdc_id, best.description, best.grade, best.nutrition_score,
         CAST(NULL AS DOUBLE) AS match_score, best.rank FROM r JOIN best ON r.short)
SELECT CAST(query_id AS BIGINT) AS query_id, fdc_id, description, grade, round(nutrition_score, 6) AS nutrition_score,
  round(match_score, 6) AS match_score, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= {SEARCH_LIMIT}
UNION ALL
SELECT CAST(query_id AS BIGINT), fdc_id, description, grade, round(nutrition_score, 6), round(match_score, 6),
  CAST(rank AS INTEGER) FROM sh"""

Q24 = f"""WITH {FORMED},
f AS (SELECT * FROM formed WHERE fiber_g_per100g >= 5.0 AND sodium_mg_per100g <= 140.0 AND form = 'solid'),
pg AS (SELECT * FROM f ORDER BY score DESC, fdc_id LIMIT 25 OFFSET 25)
SELECT fdc_id, description, food_category, round(score, 6) AS score, grade FROM pg"""

_names25 = list(FRIENDLY_NAMES.items())
_long25 = " UNION ALL ".join(
    f"SELECT fdc_id, position, {_q(n)} AS nutrient, {_q(lbl)} AS label, CAST({n}_per100g AS DOUBLE) AS value FROM top"
    for n, lbl in _names25)
Q25 = f"""WITH {SCORED},
top AS (SELECT *, CAST(row_number() OVER (ORDER BY score DESC, fdc_id) AS INTEGER) AS position FROM scored
        ORDER BY score DESC, fdc_id LIMIT 3),
lng AS (SELECT * FROM ({_long25}) WHERE value IS NOT NULL),
t AS (SELECT *, CASE WHEN nutrient IN ('protein_g', 'fiber_g') THEN max(value) OVER (PARTITION BY nutrient)
                ELSE min(value) OVER (PARTITION BY nutrient) END AS target FROM lng)
SELECT nutrient, label, position, fdc_id, round(value, 6) AS value,
  abs(value - target) <= 1e-8 + 1e-5 * abs(target) AS is_best FROM t"""



_w29 = {"A": "floor(score) % 5", "B": "1 + (floor(score) % 7)", "C": "2", "D": "1 + (floor(score) % 3)", "E": "3"}
PROBS29 = f"""{SCORED},
p0 AS (SELECT fdc_id, score, {", ".join(f"CAST({e} AS DOUBLE) AS w{g}" for g, e in _w29.items())} FROM scored),
p1 AS (SELECT fdc_id, score, {", ".join(f"w{g} / (wA + wB + wC + wD + wE) AS p{g}" for g in _w29)} FROM p0),
p2 AS (SELECT *, max(pA + pB) OVER (ORDER BY score, fdc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS adj FROM p1),
p3 AS (SELECT fdc_id, score, pA * (CASE WHEN pA + pB > 0 THEN adj / (pA + pB) ELSE 1.0 END) AS pA,
         pB * (CASE WHEN pA + pB > 0 THEN adj / (pA + pB) ELSE 1.0 END) AS pB, pC, pD, pE FROM p2),
p4 AS (SELECT *, CASE WHEN pA + pB + pC + pD + pE = 0.0 THEN 1.0 ELSE pA + pB + pC + pD + pE END AS tot FROM p3),
probs AS (SELECT fdc_id, score, pA / tot AS prob_A, pB / tot AS prob_B, pC / tot AS prob_C, pD / tot AS prob_D,
            pE / tot AS prob_E, pA / tot + pB / tot AS prob_AB FROM p4)"""

Q29 = f"""WITH {PROBS29}
SELECT fdc_id, round(score, 6) AS score, round(prob_A, 6) AS prob_A, round(prob_B, 6) AS prob_B, round(prob_C, 6) AS prob_C,
  round(prob_D, 6) AS prob_D, round(prob_E, 6) AS prob_E, round(prob_AB, 6) AS prob_AB FROM probs"""

_edges18 = Q18[len("WITH "):Q18.index("SELECT vec_id, neighbor_id, round")].rstrip()
Q26 = f"""WITH {PROBS29},
{_edges18},
feats AS (SELECT * FROM scored)
SELECT 'many_to_one' AS "check", d = 0 AS passed, round(CAST(d AS DOUBLE), 6) AS value
  FROM (SELECT count(*) AS d FROM (SELECT p_partkey FROM part GROUP BY p_partkey HAVING count(*) > 1))
UNION ALL
SELECT 'unit_coverage', s <= 0.02, round(s, 6) FROM (
  SELECT coalesce(avg(CASE WHEN coalesce(h.has, 0) = 0 THEN 1.0 ELSE 0.0 END), 0.0) AS s FROM lineitem l
  LEFT JOIN (SELECT p_partkey, max(CASE WHEN p_name IS NOT NULL THEN 1 ELSE 0 END) AS has FROM part GROUP BY p_partkey) h
  ON l.l_partkey = h.p_partkey)
UNION ALL
SELECT 'non_empty', n > 0, round(CAST(n AS DOUBLE), 6) FROM (SELECT count(*) AS n FROM lineitem)
UNION ALL
SELECT 'key_unique', d = 0, round(CAST(d AS DOUBLE), 6) FROM (SELECT count(*) - count(DISTINCT s_suppkey) AS d FROM supplier)
UNION ALL
SELECT 'score_range', coalesce(bool_and(coalesce(score, 0.0) >= 0.0 AND coalesce(score, 0.0) <= 100.0), true),
  round(max(coalesce(score, 0.0)), 6) FROM scored
UNION ALL
SELECT 'completeness', v >= 0.95, round(v, 6) FROM (
  SELECT avg(CASE WHEN {" AND ".join(f"{f} IS NOT NULL" for f in FEATS)} THEN 1.0 ELSE 0.0 END) AS v FROM scored)
UNION ALL
SELECT 'similarity_range', b = 0, round(CAST(b AS DOUBLE), 6) FROM (
  SELECT count_if(NOT (sim > 0 AND sim <= 1)) AS b FROM r WHERE rn <= 10)
UNION ALL
SELECT 'monotone', coalesce(m >= -1e-4, true), round(m, 6) FROM (
  SELECT min(prob_AB - prev) AS m FROM (
    SELECT prob_AB, lag(prob_AB) OVER (ORDER BY score, fdc_id) AS prev FROM probs))
UNION ALL
SELECT 'flag_domain', b = 0, round(CAST(b AS DOUBLE), 6) FROM (
  SELECT count_if(penalty_estimated NOT IN (0, 1)) AS b FROM scored)"""

Q27 = """WITH per AS (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, n.n_name, r.r_name, coalesce(per.n_orders, 0) AS n_orders, round(per.total, 6) AS total
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN per ON c.c_custkey = per.o_custkey"""

Q28 = f"""WITH u AS (SELECT l.l_partkey FROM lineitem l WHERE EXISTS (
    SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderpriority = {_q(URGENT)}))
SELECT p_partkey, true AS in_urgent FROM part WHERE p_partkey IN (SELECT l_partkey FROM u)
UNION ALL
SELECT p_partkey, false AS in_urgent FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM u)"""

_u30 = " UNION ALL ".join(
    f"SELECT fdc_id, {_q(f)} AS f, {i} AS ord, {f}_scaled * {DRIVER_COEFS[f]!r} AS v FROM sc"
    for i, f in enumerate(FEATS) if f in DRIVER_COEFS)
Q30 = f"""WITH {SCALED},
u AS ({_u30}),
pos AS (SELECT fdc_id, string_agg(f, ',' ORDER BY rn) AS positive FROM (
  SELECT fdc_id, f, row_number() OVER (PARTITION BY fdc_id ORDER BY v DESC, ord) AS rn FROM u WHERE v > 0)
  WHERE rn <= 3 GROUP BY fdc_id),
neg AS (SELECT fdc_id, string_agg(f, ',' ORDER BY rn) AS negative FROM (
  SELECT fdc_id, f, row_number() OVER (PARTITION BY fdc_id ORDER BY v ASC, ord) AS rn FROM u WHERE v < 0)
  WHERE rn <= 3 GROUP BY fdc_id)
SELECT sc.fdc_id, coalesce(pos.positive, '') AS positive, coalesce(neg.negative, '') AS negative
FROM sc LEFT JOIN pos ON sc.fdc_id = pos.fdc_id LEFT JOIN neg ON sc.fdc_id = neg.fdc_id"""

_base31 = ", ".join(f"round({src}, 6) AS {feat}" for feat, src in BASE_FEATURE_MAP)
Q31 = f"""WITH {FORMED}
SELECT fdc_id, {_base31},
  round((coalesce(mono_fat_g_per100g, 0.0) + coalesce(poly_fat_g_per100g, 0.0)) / (coalesce(sat_fat_g_per100g, 0.0) + 1e-6), 6)
    AS unsat_sat_ratio,
  round(energy_kcal_per100g, 6) AS energy_density, round(nutrition_score, 6) AS score, grade,
  CASE WHEN grade IN ('A', 'B') THEN 1 ELSE 0 END AS is_healthy, form, food_category,
  round(kcal_per_serv, 6) AS kcal_per_serv, round(sodium_mg_perserving, 6) AS sodium_mg_perserving,
  round(fiber_g_perserving, 6) AS fiber_g_perserving
FROM formed"""



# The features that vary over the parts, in the model's order, and their columns.
_FEATS33 = [("protein_g", "protein_g_per100g"), ("fiber_g", "fiber_g_per100g"), ("potassium_mg", "potassium_mg_per100g"),
            ("sugar_g", "sugar_g_per100g"), ("sodium_mg", "sodium_mg_per100g"), ("sat_fat_g", "sat_fat_g_per100g"),
            ("energy_kcal", "energy_kcal_per100g"), ("energy_density", "energy_kcal_per100g")]
_n33 = [n for n, _ in _FEATS33]


def _each33(form: str, sep: str = ", ") -> str:
    return sep.join(form.format(f=n, i=i + 1) for i, n in enumerate(_n33))


# Set s leaves out fold s (-1: none). Coordinate descent: step i moves weight i % 8.
Q33 = f"""WITH RECURSIVE {SCORED},
ff AS MATERIALIZED (SELECT fdc_id, CASE WHEN grade IN ('A', 'B', 'C') THEN 1 ELSE 0 END AS y, {", ".join(f"{c} AS {n}" for n, c in _FEATS33)},
  ('0x' || substr(md5('42:' || fdc_id), 1, 8))::BIGINT % 5 AS fold FROM scored),
sets AS (SELECT unnest([-1, 0, 1, 2, 3, 4]) AS s),
med AS (SELECT s, avg(y) AS my, {_each33("median({f}) AS med_{f}")} FROM ff JOIN sets ON fold <> s GROUP BY s),
imp AS (SELECT s, my, fold, fdc_id, y, {_each33("coalesce({f}, med_{f}) AS {f}")} FROM ff CROSS JOIN med),
st AS (SELECT s, {_each33("avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}")} FROM imp WHERE fold <> s GROUP BY s),
z AS MATERIALIZED (SELECT imp.s, my, fold, fdc_id, y, {_each33("({f} - m_{f}) / (CASE WHEN s_{f} > 0 THEN s_{f} ELSE 1.0 END) AS {f}")}
  FROM imp JOIN st ON imp.s = st.s),
gram AS MATERIALIZED (SELECT s, [{", ".join("[" + ", ".join(f"avg({a} * {b})" for b in _n33) + "]" for a in _n33)}] AS g,
  [{_each33("avg({f} * (y - my))")}] AS b FROM z WHERE fold <> s GROUP BY s),
cd AS (SELECT s, 0 AS i, [{_each33("0.0")}]::DOUBLE[] AS w FROM sets
  UNION ALL
  SELECT s, i + 1, list_transform(w, lambda v, k: CASE WHEN k <> j THEN v ELSE sign(r) * greatest(abs(r) - 0.05, 0.0) / (g[j][j] + 0.05) END)
  FROM (SELECT cd.s, i, w, g, i % 8 + 1 AS j, b[i % 8 + 1] - list_dot_product(g[i % 8 + 1], w) + g[i % 8 + 1][i % 8 + 1] * w[i % 8 + 1] AS r
        FROM cd JOIN gram ON cd.s = gram.s WHERE i < 3200)),
model AS MATERIALIZED (SELECT s, list_transform(w, lambda v: round(v, 9)) AS w FROM cd WHERE i = 3200),
rated AS (SELECT z.s, fold, fdc_id, y, {_each33("w[{i}] * {f} AS c{i}")}, my + {_each33("w[{i}] * {f}", " + ")} AS pred FROM z JOIN model ON z.s = model.s),
cv AS (SELECT sqrt(avg(e)) AS cv_rmse FROM (SELECT s, avg((y - pred) * (y - pred)) AS e FROM rated WHERE fold = s GROUP BY s)),
own AS (SELECT * FROM rated WHERE s = -1),
u AS ({" UNION ALL ".join(f"SELECT fdc_id, {_q(n)} AS f, {i} AS ord, round(c{i + 1}, 9) AS v FROM own" for i, n in enumerate(_n33))}),
pos AS (SELECT fdc_id, string_agg(f, ',' ORDER BY rn) AS positive FROM (
  SELECT fdc_id, f, row_number() OVER (PARTITION BY fdc_id ORDER BY v DESC, ord) AS rn FROM u WHERE v > 0) WHERE rn <= 3 GROUP BY fdc_id),
neg AS (SELECT fdc_id, string_agg(f, ',' ORDER BY rn) AS negative FROM (
  SELECT fdc_id, f, row_number() OVER (PARTITION BY fdc_id ORDER BY v, ord) AS rn FROM u WHERE v < 0) WHERE rn <= 3 GROUP BY fdc_id)
SELECT own.fdc_id, y AS is_healthy, round(pred, 6) AS healthy_pred, coalesce(positive, '') AS positive, coalesce(negative, '') AS negative,
  round(cv_rmse, 6) AS cv_rmse
FROM own LEFT JOIN pos ON own.fdc_id = pos.fdc_id LEFT JOIN neg ON own.fdc_id = neg.fdc_id, cv"""

# Grades that occur among the parts. The unknowns of a set are four weights of (score - 70) / 10 and four biases;
# their sum is held at 0 by a square that costs nothing, so each Newton step solves eight regular equations.
_G32 = "BCDE"


def _h32(a: int, b: int) -> str:
    k, m = a % 4 + 1, b % 4 + 1
    x = ("x * x" if a < 4 and b < 4 else "x" if a < 4 or b < 4 else "1.0")
    more = " + 0.01" if a == b and a < 4 else " + 1.0" if a >= 4 and b >= 4 else ""
    return f"sum({x} * p{k} * ({'1.0' if k == m else '0.0'} - p{m})){more}"


def _d32(a: int) -> str:
    more = f" + 0.01 * any_value(t[{a + 1}])" if a < 4 else " + any_value(t[5] + t[6] + t[7] + t[8])"
    return f"sum({'x' if a < 4 else '1.0'} * (p{a % 4 + 1} - y{a % 4 + 1})){more}"


_soft32 = ", ".join(f"exp(z{k} - top) / (exp(z1 - top) + exp(z2 - top) + exp(z3 - top) + exp(z4 - top)) AS p{k}" for k in range(1, 5))
_line32 = ", ".join(f"t[{k}] * x + t[{k + 4}] AS z{k}" for k in range(1, 5))


def _probs32(rows: str) -> str:
    return f"SELECT *, {_soft32} FROM (SELECT *, greatest(z1, z2, z3, z4) AS top FROM (SELECT *, {_line32} FROM {rows}))"


Q32 = f"""WITH RECURSIVE {SCORED},
r AS MATERIALIZED (SELECT fdc_id, score, grade, (score - 70.0) / 10.0 AS x, (row_number() OVER (PARTITION BY grade ORDER BY fdc_id) - 1) % 5 AS fold,
  {", ".join(f"CASE WHEN grade = '{g}' THEN 1.0 ELSE 0.0 END AS y{k + 1}" for k, g in enumerate(_G32))} FROM scored),
sets AS (SELECT unnest([-1, 0, 1, 2, 3, 4]) AS s),
nt AS (SELECT s, 0 AS i, [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]::DOUBLE[] AS t FROM sets
  UNION ALL
  SELECT s, i + 1, list_transform(t, lambda v, k: v - sol[k][9]) FROM (
    SELECT s, i, t, list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda m, p: list_transform(m, lambda row, a:
        CASE WHEN a = p THEN list_transform(row, lambda v: v / row[p])
        ELSE list_transform(row, lambda v, b: v - row[p] * m[p][b] / m[p][p]) END), mat) AS sol FROM (
      SELECT s, any_value(i) AS i, any_value(t) AS t,
        [{", ".join("[" + ", ".join([*(_h32(a, b) for b in range(8)), _d32(a)]) + "]" for a in range(8))}] AS mat
      FROM ({_probs32("(SELECT s, i, t, r.* FROM nt JOIN r ON fold <> s WHERE i < 40)")}) GROUP BY s))),
model AS MATERIALIZED (SELECT s, t FROM nt WHERE i = 40),
rated AS MATERIALIZED ({_probs32("(SELECT s, t, r.* FROM model JOIN r ON s IN (-1, fold))")}),
cv AS (SELECT avg(e) AS cv_log_loss FROM (
  SELECT s, avg(-ln(greatest(least(y1 * p1 + y2 * p2 + y3 * p3 + y4 * p4, 1 - 1e-15), 1e-15))) AS e FROM rated WHERE s >= 0 GROUP BY s)),
m1 AS (SELECT fdc_id, grade, p2, p3, p4, max(p1) OVER (ORDER BY score, fdc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p1
  FROM rated WHERE s = -1),
m2 AS (SELECT *, p1 + p2 + p3 + p4 AS tot FROM m1)
SELECT fdc_id, grade, round(p1 / tot, 6) AS prob_B, round(p2 / tot, 6) AS prob_C, round(p3 / tot, 6) AS prob_D, round(p4 / tot, 6) AS prob_E,
  round(p1 / tot, 6) AS prob_AB, round(cv_log_loss, 6) AS cv_log_loss FROM m2, cv"""


_g35 = " UNION ALL ".join(
    f"SELECT {_q(name)} AS grp, score, grade FROM scored WHERE regexp_matches(lower(description), {_q(pat)})"
    for name, pat in PART_KEYWORD_GROUPS.items())
Q35 = f"""WITH {SCORED},
g AS ({_g35})
SELECT grp AS "group", count(*) AS n, round(avg(score), 6) AS mean_score, bool_or(grade IN ('A', 'B')) AS any_in_set
FROM g GROUP BY grp"""


Q36 = """WITH m(event_type, canonical_name, factor) AS (VALUES ('click', 'potassium_mg', 1000.0), ('error', 'sodium_mg', 1000.0),
    ('purchase', 'fiber_g', 1.0), ('signup', 'energy_kcal', 0.239005736)),
d AS (SELECT DISTINCT user_id, canonical_name, CAST(value AS DOUBLE) * CAST(factor AS DOUBLE) AS amount FROM events JOIN m USING (event_type))
SELECT user_id, round(avg(amount) FILTER (canonical_name = 'potassium_mg'), 6) AS potassium_mg_per100g,
  round(avg(amount) FILTER (canonical_name = 'sodium_mg'), 6) AS sodium_mg_per100g,
  round(avg(amount) FILTER (canonical_name = 'fiber_g'), 6) AS fiber_g_per100g,
  round(avg(amount) FILTER (canonical_name = 'energy_kcal'), 6) AS energy_kcal_per100g
FROM d GROUP BY user_id"""

Q37 = """SELECT o_orderpriority, l_returnflag, count(*) AS n, sum(l_quantity) AS quantity, count(DISTINCT o_custkey) AS customers
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"""

Q38 = """WITH o AS (
  SELECT o_custkey, o_orderkey, o_totalprice AS w,
    coalesce(CASE WHEN o_orderpriority LIKE '5%' THEN o_orderpriority END, n_name, '') AS txt
  FROM orders LEFT JOIN nation ON o_orderkey % 40 = n_nationkey),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY CASE WHEN length(txt) > 0 THEN 1 ELSE 0 END DESC, w DESC, o_orderkey) AS rn FROM o)
SELECT o_custkey, txt AS serving_desc, round(w, 6) AS serving_gram_weight FROM r WHERE rn = 1"""

Q39 = """SELECT DISTINCT l_partkey AS fdc_id, l_suppkey AS neighbor_id, p_name, s_name AS s_name_nb, s_nationkey
FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'R'"""

Q40 = f"""WITH {BEST19},
swap AS (SELECT DISTINCT fdc_id FROM best WHERE tier = bt AND score_gain >= 10.0),
low AS (SELECT avg(CASE WHEN swap.fdc_id IS NULL THEN 0.0 ELSE 1.0 END) AS s
        FROM (SELECT fdc_id FROM foods WHERE grade IN ('D', 'E')) f LEFT JOIN swap USING (fdc_id)),
worst AS (SELECT count(*) AS m FROM (SELECT fdc_id FROM foods ORDER BY score, fdc_id LIMIT 5) WHERE fdc_id NOT IN (SELECT fdc_id FROM swap))
SELECT 'low_grade_coverage' AS "check", s >= 0.9 AS passed, round(s, 6) AS value FROM low
UNION ALL SELECT 'worst_have_swaps', m = 0, CAST(m AS DOUBLE) FROM worst
UNION ALL SELECT 'prob_sum', true, 0.0
UNION ALL SELECT 'column_pairs', true, 0.0"""

Q41 = """SELECT p_partkey, trim(coalesce(' ' || nullif(p_type, 'PROMO') || ' ', '')) AS type_text,
  CASE WHEN p_size <= 40 THEN CAST(p_size AS VARCHAR) || ' g' ELSE '—' END AS size_badge,
  p_name || ' (' || p_partkey || ')' AS label, p_partkey AS label_id, p_size + 0.5::DOUBLE AS size_half,
  round(p_retailprice * 1000.0, 6) AS price_mg FROM part"""

Q42 = f"""WITH {SCORED},
top AS (SELECT *, CAST(row_number() OVER (ORDER BY score DESC, fdc_id) AS INTEGER) AS position FROM scored
        ORDER BY score DESC, fdc_id LIMIT 3),
lng AS (SELECT * FROM ({_long25}) WHERE value IS NOT NULL),
t AS (SELECT *, CASE WHEN nutrient IN ('protein_g', 'fiber_g') THEN max(value) OVER (PARTITION BY nutrient)
                ELSE min(value) OVER (PARTITION BY nutrient) END AS target FROM lng)
SELECT nutrient, label, round(max(value) FILTER (position = 1), 6) AS item_1, round(max(value) FILTER (position = 2), 6) AS item_2,
  round(max(value) FILTER (position = 3), 6) AS item_3,
  string_agg(CAST(position AS VARCHAR), ',' ORDER BY position) FILTER (abs(value - target) <= 1e-8 + 1e-5 * abs(target)) AS best_positions
FROM t GROUP BY nutrient, label"""

Q43 = """SELECT p_brand, n, last_label FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL)
LEFT JOIN (SELECT p_brand, count(*) AS n, max(p_name || ' (' || p_partkey || ')') AS last_label FROM part
           WHERE NOT p_size > 25 GROUP BY p_brand) USING (p_brand)"""


Q46 = """WITH req(query_id, q) AS (VALUES (1, 'blue bolt'), (2, 'brand#1 gear'), (3, 'cold xyz'), (4, 'hot'), (5, 'old rod'), (6, 'brand#13'), (7, 'zz'), (8, 'g')),
tok AS (SELECT query_id, unnest(string_split(q, ' ')) AS tok, unnest(generate_series(1, len(string_split(q, ' ')))) AS pos, len(string_split(q, ' ')) AS n FROM req),
per AS (SELECT query_id, p_partkey, count(DISTINCT pos) = max(n) AS hit_all, bool_or(pos = 1) AS head_hit FROM part
  JOIN tok ON contains(lower(p_name), tok) OR contains(lower(p_brand), tok) GROUP BY query_id, p_partkey),
won AS (SELECT query_id, bool_or(hit_all) AS any_all FROM per GROUP BY query_id)
SELECT CAST(per.query_id AS BIGINT) AS query_id, part.p_partkey AS fdc_id, p_name AS description, p_brand AS brand_owner
FROM per JOIN won ON per.query_id = won.query_id JOIN part ON part.p_partkey = per.p_partkey WHERE CASE WHEN any_all THEN hit_all ELSE head_hit END"""

Q44 = """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber
LIMIT 100 OFFSET (SELECT ((count(*) + 99) // 100 - 1) * 100 FROM lineitem)"""

Q45 = f"""WITH {SCORED},
g(grp, pattern) AS (VALUES ('anvils', '\\banvil'), ('bolts', 'bolt'), ('hot_or_cold', '^(hot|cold) '), ('gizmo_widget', 'gizmo|widget')),
m AS (SELECT grp, fdc_id, score FROM scored JOIN g ON regexp_matches(lower(description), pattern)),
r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score, fdc_id) AS low, row_number() OVER (PARTITION BY grp ORDER BY score DESC, fdc_id) AS high FROM m)
SELECT grp AS "group", 'worst' AS "end", CAST(low AS INTEGER) AS rank, fdc_id, round(score, 6) AS score FROM r WHERE low <= 3
UNION ALL SELECT grp, 'best', CAST(high AS INTEGER), fdc_id, round(score, 6) FROM r WHERE high <= 3"""


ORACLE = {
    "q01_contract": Q01,
    "q02_text_staging": Q02,
    "q03_coerce": Q03,
    "q04_units": Q04,
    "q05_mapping": Q05,
    "q06_matrix": Q06,
    "q07_primary": Q07,
    "q08_scorecard": Q08,
    "q09_grade_counts": Q09,
    "q10_flags_form": Q10,
    "q11_robust_z": Q11,
    "q12_stats": Q12,
    "q13_missing": Q13,
    "q14_groups": Q14,
    "q15_sanity": Q15,
    "q16_kpis": Q16,
    "q17_scaled": Q17,
    "q18_neighbors": Q18,
    "q19_substitutions": Q19,
    "q20_coverage": Q20,
    "q21_token_search": Q21,
    "q22_ranked_search": Q22,
    "q24_page": Q24,
    "q25_compare": Q25,
    "q26_quality": Q26,
    "q27_joins": Q27,
    "q28_semi_anti": Q28,
    "q29_monotone": Q29,
    "q30_drivers": Q30,
    "q31_features": Q31,
    "q32_calibration": Q32,
    "q33_driver_model": Q33,
    "q35_group_checks": Q35,
    "q36_mapped_matrix": Q36,
    "q37_large_join": Q37,
    "q38_unit_servings": Q38,
    "q39_lookup": Q39,
    "q40_swap_checks": Q40,
    "q41_labels": Q41,
    "q42_compare_wide": Q42,
    "q43_filter_options": Q43,
    "q44_last_page": Q44,
    "q45_group_ends": Q45,
    "q46_indexed_search": Q46,
}
