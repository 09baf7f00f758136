"""DuckDB SQL text of the pipeline stages, used as the correctness oracle.

Each stage is a CTE body over the previous stage, so a query is the chain of
CTEs it needs plus a final SELECT. The text is independent SQL written from the
operator semantics; the Spark side never executes it.
"""

from __future__ import annotations

from newsrisk.functions.codes import CONFLICT_CODES, CONFLICT_CODES_WEIGHTED10, ROOT_LABELS
from newsrisk.sources.adapters import ARTICLES_SQL, RAW_EVENTS_SQL


def q(items) -> str:
    return ", ".join(f"'{x}'" for x in items)


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes)
    return f"WITH {body}\n{final}"


def r(expr: str, alias: str | None = None) -> str:
    """Round a double for the comparison (both engines round the final output)."""
    return f"ROUND({expr}, 10) AS {alias or expr}"


ROOT_LABEL_CASE = (
    "CASE EventRootCode "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ROOT_LABELS.items())
    + " ELSE 'Unknown' END"
)

def stable_avg_sql(x: str) -> str:
    """Order-stable mean: integer sum of the 2**-20 multiples + double sum of the remainders."""
    hi = f"CASE WHEN ABS({x}) < {2.0**40} THEN CAST(FLOOR({x} * 1048576.0) AS BIGINT) END"
    return (
        f"(CAST(SUM({hi}) AS DOUBLE) / 1048576.0 + SUM({x} - CAST(COALESCE({hi}, 0) AS DOUBLE) / 1048576.0)) "
        f"/ CAST(COUNT({x}) AS DOUBLE)"
    )


EXTRACT = """
SELECT SQLDATE, ActionGeo_CountryCode AS CountryCode, EventRootCode,
       COUNT(1) AS EventCount,
       {stable_tone} AS AvgTone,
       {stable_gold} AS AvgGoldstein,
       CAST(SUM(NumMentions) AS BIGINT) AS TotalMentions,
       CAST(SUM(NumArticles) AS BIGINT) AS TotalArticles,
       CAST(SUM(NumSources) AS BIGINT) AS TotalSources
FROM raw_events
WHERE ActionGeo_CountryCode IS NOT NULL {window}
GROUP BY SQLDATE, ActionGeo_CountryCode, EventRootCode
"""

CLEAN_NORM = """
SELECT CAST(SQLDATE AS VARCHAR) AS SQLDATE, CountryCode,
       CASE WHEN length(t) >= 2 THEN t WHEN t IN ('+', '-') THEN t || '0' ELSE lpad(t, 2, '0') END
         AS EventRootCode,
       EventCount, AvgTone, AvgGoldstein, TotalMentions, TotalArticles, TotalSources
FROM (SELECT *, regexp_replace(CAST(EventRootCode AS VARCHAR), '^\\s+|\\s+$', '', 'g') AS t FROM extract)
"""

CLEAN = f"""
SELECT SQLDATE, CountryCode, EventRootCode, EventCount, AvgTone, AvgGoldstein,
       TotalMentions, TotalArticles, TotalSources,
       CAST(TRY_STRPTIME(SQLDATE, '%Y%m%d') AS DATE) AS date,
       {ROOT_LABEL_CASE} AS EventRootLabel,
       CASE WHEN AvgTone IS NULL OR isnan(AvgTone) THEN 'unknown'
            WHEN AvgTone <= -2 THEN 'negative'
            WHEN AvgTone >= 2 THEN 'positive'
            ELSE 'neutral' END AS ToneBucket
FROM clean_norm
"""

# The published weights.
RISK = f"""
SELECT date, CountryCode, total_events, conflict_events, negative_tone_events, weighted_avg_tone,
       conflict_events / NULLIF(total_events, 0) AS conflict_share,
       negative_tone_events / NULLIF(total_events, 0) AS negative_share,
       LN(1 + total_events) AS log_events,
       1.5 * (conflict_events / NULLIF(total_events, 0))
         + 1.0 * (negative_tone_events / NULLIF(total_events, 0))
         + 0.5 * LN(1 + total_events) AS risk_raw
FROM (
  SELECT date, CountryCode,
         CAST(SUM(EventCount) AS BIGINT) AS total_events,
         CAST(SUM(CASE WHEN lpad(EventRootCode, 2, '0') IN ({q(CONFLICT_CODES)}) THEN EventCount ELSE 0 END)
              AS BIGINT) AS conflict_events,
         CAST(SUM(CASE WHEN AvgTone <= -2 THEN EventCount ELSE 0 END) AS BIGINT) AS negative_tone_events,
         SUM(AvgTone * EventCount) / NULLIF(SUM(EventCount), 0) AS weighted_avg_tone
  FROM clean WHERE CountryCode IS NOT NULL AND date IS NOT NULL
  GROUP BY date, CountryCode)
"""

# The published weights.
RISK_WEIGHTED10 = f"""
SELECT date, CountryCode, total_events, conflict_events, conflict_share, negative_share, weighted_avg_tone,
       10.0 * (0.6 * negative_share + 0.4 * conflict_share) + LN(1 + total_events) / 5.5 AS risk_raw
FROM (
  SELECT date, CountryCode,
         CAST(SUM(EventCount) AS BIGINT) AS total_events,
         CAST(SUM(CASE WHEN EventRootCode IN ({q(CONFLICT_CODES_WEIGHTED10)}) THEN EventCount ELSE 0 END)
              AS BIGINT) AS conflict_events,
         SUM(CASE WHEN EventRootCode IN ({q(CONFLICT_CODES_WEIGHTED10)}) THEN EventCount ELSE 0 END)
           / NULLIF(SUM(EventCount), 0) AS conflict_share,
         SUM(CASE WHEN ToneBucket = 'negative' THEN EventCount ELSE 0 END) / NULLIF(SUM(EventCount), 0)
           AS negative_share,
         SUM(AvgTone * EventCount) / NULLIF(SUM(EventCount), 0) AS weighted_avg_tone
  FROM clean WHERE date IS NOT NULL AND CountryCode IS NOT NULL
  GROUP BY date, CountryCode)
"""


def events_chain(kind: str = "dense", upto: str = "clean", window: str = "") -> list[tuple[str, str]]:
    """CTE chain raw_events -> extract -> clean_norm -> clean -> risk."""
    extract = EXTRACT.format(
        window=window, stable_tone=stable_avg_sql("AvgTone"), stable_gold=stable_avg_sql("GoldsteinScale")
    )
    chain = [
        ("raw_events", RAW_EVENTS_SQL[kind]),
        ("extract", extract),
        ("clean_norm", CLEAN_NORM),
        ("clean", CLEAN),
        ("risk", RISK),
    ]
    names = [n for n, _ in chain]
    return chain[: names.index(upto) + 1]


def articles_chain() -> list[tuple[str, str]]:
    return [("raw_articles", ARTICLES_SQL)]


# ---- features / panel (CTE bodies over `risk` / `clean`) ---------------------

W7 = "PARTITION BY CountryCode ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"
WROW = "PARTITION BY CountryCode ORDER BY date"


def rolling(col: str, fn: str) -> str:
    return f"CASE WHEN COUNT({col}) OVER ({W7}) >= 3 THEN {fn}({col}) OVER ({W7}) END"


def features_body(src: str = "risk", value: str = "risk_raw") -> str:
    lags = ", ".join(f"LAG({value}, {k}) OVER ({WROW}) AS lag_{k}" for k in (1, 2, 3, 7, 14))
    return (
        f"SELECT *, {lags}, {rolling(value, 'AVG')} AS roll_mean_7, {rolling(value, 'STDDEV_SAMP')} AS roll_std_7, "
        f"LEAD({value}, 1) OVER ({WROW}) AS target_next_day FROM {src}"
    )


FILL_CALENDAR = """
SELECT s.date, s.CountryCode, COALESCE(r.risk_raw, 0.0) AS risk_raw, r.total_events
FROM (SELECT CountryCode, CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT CountryCode, MIN(date) AS lo, MAX(date) AS hi FROM risk GROUP BY CountryCode)) s
LEFT JOIN risk r ON r.CountryCode = s.CountryCode AND r.date = s.date
"""

FEATURE_COLS = [
    "lag_1", "lag_2", "lag_3", "lag_7", "lag_14", "roll_mean_7", "roll_std_7",
    "total_events", "conflict_share", "negative_share", "weighted_avg_tone",
]
SERIES_FEATURE_COLS = FEATURE_COLS[:7]


def not_null(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


PANEL = """
SELECT date, CountryCode, EventCount, TotalMentions, TotalArticles, TotalSources,
       tone_x_events / NULLIF(EventCount, 0) AS AvgTone,
       gold_x_events / NULLIF(EventCount, 0) AS AvgGoldstein,
       LN(1 + EventCount) AS log_events, LN(1 + TotalMentions) AS log_mentions
FROM (
  SELECT date, CountryCode,
         CAST(COALESCE(SUM(EventCount), 0) AS BIGINT) AS EventCount,
         CAST(COALESCE(SUM(TotalMentions), 0) AS BIGINT) AS TotalMentions,
         CAST(COALESCE(SUM(TotalArticles), 0) AS BIGINT) AS TotalArticles,
         CAST(COALESCE(SUM(TotalSources), 0) AS BIGINT) AS TotalSources,
         COALESCE(SUM(AvgTone * EventCount), 0.0) AS tone_x_events,
         COALESCE(SUM(AvgGoldstein * EventCount), 0.0) AS gold_x_events
  FROM clean WHERE date IS NOT NULL AND CountryCode IS NOT NULL
  GROUP BY date, CountryCode)
"""

Z_SPECS = [
    ("log_events", "z_events_7d"),
    ("log_mentions", "z_mentions_7d"),
    ("AvgTone", "z_tone_7d"),
    ("AvgGoldstein", "z_goldstein_7d"),
]


def z_expr(col: str) -> str:
    sd = f"STDDEV_SAMP({col}) OVER ({W7})"
    return (
        f"COALESCE(CASE WHEN COUNT({col}) OVER ({W7}) >= 3 AND {sd} > 1e-12 "
        f"THEN ({col} - AVG({col}) OVER ({W7})) / {sd} END, 0.0)"
    )


ROLLING_Z = "SELECT *, " + ", ".join(f"{z_expr(c)} AS {z}" for c, z in Z_SPECS) + " FROM panel"


def scaled_body(src: str = "zpanel") -> str:
    parts = []
    for _, z in Z_SPECS:
        m = f"(SELECT AVG({z}) FROM {src})"
        s = f"(SELECT STDDEV_POP({z}) FROM {src})"
        parts.append(f"({z} - {m}) / (CASE WHEN {s} > 1e-12 THEN {s} ELSE 1.0 END) AS {z}_s")
    return f"SELECT *, {', '.join(parts)} FROM {src}"


# ---- isolation forest (every draw is an MD5, as in operators/isolation.py) -------


def uniform(*parts: str) -> str:
    return f"((('0x' || substr(md5({" || ':' || ".join(parts)}), 1, 8))::BIGINT + 0.5) / 4294967296.0)"


def isolation_forest(src: str = "scaled", trees: int = 300, sample: int = 256, seed: int = 42, contamination: float = 0.01) -> list[tuple[str, str]]:
    """CTEs from ``src`` (date, CountryCode, the scaled z columns) to ``iso_scored``; every tree level is one CTE."""
    x = ", ".join(f"ROUND({z}_s, 9)" for _, z in Z_SPECS)
    key = "CAST(date AS VARCHAR) || ':' || CountryCode"
    c = lambda n: f"(CASE WHEN {n} > 2 THEN 2.0 * (ln({n} - 1.0) + 0.5772156649015329) - 2.0 * ({n} - 1.0) / {n} WHEN {n} = 2 THEN 1.0 ELSE 0.0 END)"
    levels = 0
    while 1 << levels < sample:
        levels += 1
    out = [
        ("iso_rows", f"SELECT *, [{x}] AS x, {key} AS k FROM {src}"),
        ("iso_n", f"SELECT n, LEAST(n, {sample}) AS psi, LEAST(n, {trees * sample}) AS pool, GREATEST(1, LEAST(n, {trees * sample}) // {sample}) AS per_order FROM (SELECT COUNT(*) AS n FROM iso_rows)"),
        ("iso_pool", f"SELECT k, x, date, CountryCode FROM iso_rows QUALIFY ROW_NUMBER() OVER (ORDER BY md5('{seed}:pool:' || k), date, CountryCode) <= (SELECT pool FROM iso_n)"),
        ("iso_dealt", f"SELECT x, o.range AS o, (ROW_NUMBER() OVER (PARTITION BY o.range ORDER BY md5('{seed}:' || o.range || ':' || k), date, CountryCode) - 1) // {sample} AS b "
                      f"FROM iso_pool, range({trees}) o WHERE o.range * (SELECT per_order FROM iso_n) < {trees}"),
        ("iso0", f"SELECT CAST(o * per_order + b AS BIGINT) AS tree, x, CAST(1 AS BIGINT) AS node FROM iso_dealt, iso_n WHERE b < per_order AND o * per_order + b < {trees}"),
    ]
    for d in range(levels + 1):
        ranges = ", ".join(f"{{'f': {f}, 'lo': MIN(x[{f + 1}]) OVER w, 'hi': MAX(x[{f + 1}]) OVER w}}" for f in range(len(Z_SPECS)))
        u = lambda what: uniform(f"'{seed}'", "tree", "node", f"'{what}'")  # noqa: B023, E731
        out += [
            (f"iso_w{d}", f"SELECT tree, x, node, COUNT(*) OVER w AS size, list_filter([{ranges}], lambda r: r.hi > r.lo AND {d} < depth) AS usable "
                          f"FROM iso{d}, (SELECT ceil(log2(GREATEST(psi, 2))) AS depth FROM iso_n) WINDOW w AS (PARTITION BY tree, node)"),
            (f"iso_f{d}", f"SELECT *, usable[CAST(floor({u('feature')} * len(usable)) AS BIGINT) + 1] AS r FROM iso_w{d}"),
            (f"iso_t{d}", f"SELECT tree, x, node, size, r.f AS feature, r.lo + (r.hi - r.lo) * {u('threshold')} AS threshold FROM iso_f{d}"),
            (f"iso{d + 1}", f"SELECT tree, x, CASE WHEN feature IS NULL THEN node ELSE node * 2 + CASE WHEN x[feature + 1] >= threshold THEN 1 ELSE 0 END END AS node FROM iso_t{d}"),
        ]
    nodes = " UNION ALL ".join(f"SELECT DISTINCT tree, node, {d} AS depth, size, feature, threshold FROM iso_t{d}" for d in range(levels + 1))
    out.append(("iso_nodes", f"SELECT * FROM ({nodes}) QUALIFY ROW_NUMBER() OVER (PARTITION BY tree, node ORDER BY depth) = 1"))
    out.append(("walk0", f"SELECT k, x, t.range AS tree, CAST(1 AS BIGINT) AS node FROM iso_rows, range({trees}) t"))
    for d in range(levels):
        out.append((f"walk{d + 1}", f"SELECT k, x, w.tree, CASE WHEN feature IS NULL THEN w.node ELSE w.node * 2 + CASE WHEN x[feature + 1] >= threshold THEN 1 ELSE 0 END END AS node "
                                    f"FROM walk{d} w LEFT JOIN iso_nodes s ON s.tree = w.tree AND s.node = w.node AND s.depth = {d}"))  # fmt: skip
    out += [
        ("iso_paths", f"SELECT k, SUM(COALESCE(s.depth + {c('s.size')}, floor(log2(w.node)))) / {trees} AS path FROM walk{levels} w LEFT JOIN iso_nodes s ON s.tree = w.tree AND s.node = w.node GROUP BY k"),
        ("iso_raw", f"SELECT r.*, -pow(2.0, -path / {c('GREATEST(psi, 2)')}) AS s FROM iso_rows r JOIN iso_paths USING (k), iso_n"),
        ("iso_scored", f"SELECT *, s - (SELECT quantile_cont(s, {contamination}) FROM iso_raw) AS anomaly_score FROM iso_raw"),
    ]
    return out


# ---- regression forests and permutation importance -----------------------------------

# The Poisson(1) distribution function.
POISSON_CDF = [
    0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563,
    0.9994058151824183, 0.9999167588507119, 0.9999897508033253, 0.9999988747974022, 0.9999998885745217,
    0.9999999899522336, 0.9999999991683892, 0.9999999999363864,
]


def cart(src: str, features: list[str], trees: int, depth: int, seed: int = 42, model: str = "0", target: str = "target_next_day") -> list[tuple[str, str]]:
    """CTEs from training rows ``src`` (CountryCode, date, features, target) to ``cart_nodes`` (model, tree, node, feature, threshold, value, weight)."""
    u = uniform(f"'{seed}'", "CAST(m AS VARCHAR)", "CAST(t.range AS VARCHAR)", "CountryCode", "CAST(date AS VARCHAR)")
    times = " + ".join(f"CAST(u >= {c!r} AS INTEGER)" for c in POISSON_CDF)
    x = ", ".join(f"ROUND(CAST({f} AS DOUBLE), 9)" for f in features)
    drawn = f"SELECT m, t.range AS tree, [{x}] AS x, CAST(ROUND({target} * 1000000) AS BIGINT) AS y, {u} AS u FROM (SELECT *, {model} AS m FROM {src}), range({trees}) t"
    out = [("cart0", f"SELECT m, tree, CAST(1 AS BIGINT) AS node, x, y, w FROM (SELECT *, {times} AS w FROM ({drawn})) WHERE w > 0")]
    for d in range(depth):
        unnested = f"SELECT m, tree, node, w, y, UNNEST(x) AS v, UNNEST(range(len(x))) AS f FROM cart{d}"
        out += [
            (f"cart_sums{d}", f"SELECT m, tree, node, f, v, CAST(SUM(w) AS BIGINT) AS w, CAST(SUM(w * y) AS BIGINT) AS s FROM ({unnested}) GROUP BY m, tree, node, f, v"),
            (f"cart_runs{d}", f"SELECT m, tree, node, f, v, LEAD(v) OVER o AS high, CAST(SUM(w) OVER o AS BIGINT) AS lw, CAST(SUM(s) OVER o AS BIGINT) AS ls, CAST(SUM(w) OVER p AS BIGINT) AS tw, CAST(SUM(s) OVER p AS BIGINT) AS ts "
                              f"FROM cart_sums{d} WINDOW o AS (PARTITION BY m, tree, node, f ORDER BY v), p AS (PARTITION BY m, tree, node, f)"),
            (f"cart_mixed{d}", f"SELECT m, tree, node FROM cart{d} GROUP BY m, tree, node HAVING MIN(y) < MAX(y)"),
            (f"cart_best{d}", f"SELECT m, tree, node, f AS feature, v + (high - v) / 2 AS threshold, tw, ts FROM cart_runs{d} JOIN cart_mixed{d} USING (m, tree, node) WHERE high IS NOT NULL QUALIFY ROW_NUMBER() OVER ("
                              "PARTITION BY m, tree, node ORDER BY CAST(ls AS DOUBLE) * CAST(ls AS DOUBLE) / lw + CAST(ts - ls AS DOUBLE) * CAST(ts - ls AS DOUBLE) / (tw - lw) DESC, f, v) = 1"),
            (f"cart{d + 1}", f"SELECT e.m, e.tree, CASE WHEN feature IS NULL THEN e.node ELSE e.node * 2 + CAST(x[feature + 1] > threshold AS BIGINT) END AS node, x, y, w "
                             f"FROM cart{d} e LEFT JOIN cart_best{d} b ON b.m = e.m AND b.tree = e.tree AND b.node = e.node"),
        ]
    inner = " UNION ALL ".join(f"SELECT m, tree, node, feature, threshold, CAST(ts AS DOUBLE) / tw / 1000000 AS value, tw AS weight FROM cart_best{d}" for d in range(depth))
    leaves = f"SELECT m, tree, node, NULL, NULL, CAST(SUM(w * y) AS DOUBLE) / CAST(SUM(w) AS BIGINT) / 1000000, CAST(SUM(w) AS BIGINT) FROM cart{depth} GROUP BY m, tree, node"
    return out + [("cart_nodes", f"{inner} UNION ALL {leaves}")]


def cart_predictions(rows: str, features: list[str], trees: int, depth: int, model: str = "0") -> list[tuple[str, str]]:
    """CTEs from ``rows`` to ``predicted``, which adds ``prediction``; rows are told apart by (CountryCode, date)."""
    x = ", ".join(f"ROUND(CAST({f} AS DOUBLE), 9)" for f in features)
    out = [("asked", f"SELECT *, {model} AS m FROM {rows}"), ("down0", f"SELECT CountryCode, date, m, [{x}] AS x, t.range AS tree, CAST(1 AS BIGINT) AS node FROM asked, range({trees}) t")]
    for d in range(depth):
        out.append((f"down{d + 1}", f"SELECT r.CountryCode, r.date, r.m, x, r.tree, CASE WHEN feature IS NULL THEN r.node ELSE r.node * 2 + CAST(x[feature + 1] > threshold AS BIGINT) END AS node "
                                    f"FROM down{d} r LEFT JOIN cart_nodes n ON n.m = r.m AND n.tree = r.tree AND n.node = r.node"))  # fmt: skip
    mean = f"SELECT CountryCode, date, AVG(value) AS prediction FROM down{depth} r JOIN cart_nodes n ON n.m = r.m AND n.tree = r.tree AND n.node = r.node GROUP BY CountryCode, date"
    return out + [("predicted", f"SELECT asked.*, prediction FROM asked JOIN ({mean}) USING (CountryCode, date)")]


def cv_chain() -> list[tuple[str, str]]:
    """The sparse risk table's top country, its calendar filled, as series rows with ``test_fold``: ``series``."""
    top = "SELECT * FROM risk WHERE CountryCode = (SELECT CountryCode FROM risk GROUP BY CountryCode ORDER BY SUM(total_events) DESC, CountryCode LIMIT 1)"
    ranked = (f"SELECT *, ROW_NUMBER() OVER ({WROW}) - 1 AS rn, COUNT(*) OVER (PARTITION BY CountryCode) AS n FROM feat WHERE {not_null(SERIES_FEATURE_COLS + ['target_next_day'])}")
    return events_chain("sparse", "risk") + [
        ("one", top),
        ("filled", FILL_CALENDAR.replace("risk r", "one r").replace("FROM risk GROUP", "FROM one GROUP")),
        ("feat", features_body("filled")),
        ("ranked", ranked),
        ("series", "SELECT *, CAST(CASE WHEN n // 6 > 0 AND rn >= n - 5 * (n // 6) THEN (rn - (n - 5 * (n // 6))) // (n // 6) END AS INTEGER) AS test_fold FROM ranked"),
    ]


def importance(rows: str, features: list[str], predict: str, repeats: int, seed: int = 42) -> list[tuple[str, str]]:
    """CTEs from test ``rows`` to ``importance``; ``predict`` is an expression of the features."""
    replaced = ", ".join(f"CASE WHEN c.pf = '{f}' THEN v ELSE {f} END AS {f}" for f in features)
    value = "CASE pf " + " ".join(f"WHEN '{f}' THEN {f}" for f in features) + " END"
    return [
        ("placed", f"SELECT *, ROW_NUMBER() OVER (ORDER BY CountryCode, date) AS place FROM {rows}"),
        ("copies", f"SELECT p.*, UNNEST([{q(features)}]) AS pf, r.range AS rep FROM placed p, range({repeats}) r"),
        ("donors", f"SELECT pf, rep, {value} AS v, ROW_NUMBER() OVER (PARTITION BY pf, rep ORDER BY md5('{seed}:' || pf || ':' || rep || ':' || CountryCode || ':' || CAST(date AS VARCHAR)), CountryCode, date) AS place FROM copies"),
        ("moved", f"SELECT c.place, c.rep, c.pf, target_next_day, {replaced} FROM copies c JOIN donors d ON d.pf = c.pf AND d.rep = c.rep AND d.place = c.place"),
        ("base", f"SELECT SUM(target_next_day * target_next_day) - SUM(target_next_day) * SUM(target_next_day) / COUNT(*) AS tot, SUM((target_next_day - ({predict})) ** 2) AS sse FROM placed"),
        ("drops", f"SELECT pf, rep, (SUM((target_next_day - ({predict})) ** 2) - (SELECT sse FROM base)) / (SELECT tot FROM base) AS d FROM moved GROUP BY pf, rep"),
        ("importance", "SELECT pf AS feature, AVG(d) AS importance, STDDEV_POP(d) AS importance_std FROM drops GROUP BY pf"),
    ]


# ---- themes --------------------------------------------------------------------

THEME_ITEMS = """
SELECT date, theme, Tone FROM (
  SELECT dt AS date, UNNEST(string_split(V2Themes, ';')) AS theme,
         TRY_CAST(string_split(V2Tone, ',')[1] AS DOUBLE) AS Tone
  FROM raw_articles WHERE V2Themes IS NOT NULL)
WHERE theme IS NOT NULL AND theme <> ''
"""

THEME_ITEMS_STRIPPED = """
SELECT date, theme, Tone FROM (
  SELECT date, split_part(theme, ',', 1) AS theme, Tone FROM (
    SELECT dt AS date, UNNEST(string_split(V2Themes, ';')) AS theme,
           TRY_CAST(string_split(V2Tone, ',')[1] AS DOUBLE) AS Tone
    FROM raw_articles WHERE V2Themes IS NOT NULL))
WHERE theme IS NOT NULL AND theme <> ''
"""

TOP_THEMES = """
SELECT theme, COUNT(*) AS mentions FROM theme_items GROUP BY theme ORDER BY mentions DESC, theme LIMIT 200
"""

THEME_DAILY = """
SELECT date, theme, COUNT(*) AS ArticleCount, AVG(Tone) AS AvgTone
FROM theme_items WHERE theme IN (SELECT theme FROM top_themes)
GROUP BY date, theme
"""
