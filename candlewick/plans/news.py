"""News and text queries. Articles come from ``documents``; headlines and filings are worded by SQL from order columns."""

from pyspark.sql import functions as F

from candlewick import fixtures as fx
from candlewick.functions import vocabulary as voc
from candlewick.operators import news as ops
from candlewick.plans.registry import near, query, r
from candlewick.plans.sql import with_


def articles(spark, sf):
    """documents as articles: id, text, source, category, region, ts, lat, lon, tier."""
    d = fx.spread_table(spark, sf, "documents")
    i = F.col("doc_id")
    return d.select(
        i.alias("id"), "text", "source", F.col("lang").alias("category"), F.concat(F.lit("R"), i % 7).alias("region"),
        F.timestamp_seconds(F.lit(1704067200) + i * 60).alias("ts"),
        ((i * 37) % 100 / 10).alias("lat"), ((i * 73) % 90 / 10).alias("lon"), (i % 4 + 1).cast("int").alias("tier"),
    )


ARTICLES = """articles AS (SELECT doc_id AS id, text, source, lang AS category, 'R' || (doc_id % 7) AS region, TIMESTAMP '2024-01-01' + to_seconds(doc_id * 60) AS ts,
  ((doc_id * 37) % 100) / 10 AS lat, ((doc_id * 73) % 90) / 10 AS lon, doc_id % 4 + 1 AS tier FROM documents)"""

# One headline per order, worded from its columns; the same text in both engines.
PLACES = "China, London, Tokyo, Tel Aviv, South Korea, the EU, Brazil, Rome, Mexico City, Moscow, Kyiv, India"
SUBJECTS = "President Anna Berg, CEO Otto Lang, Powell, Musk, the Fed, NATO, Apple, OPEC, ACME, the World Bank"
VERBS = "cheers record high, warns of recession, sees strong growth, fears crash, reports loss, expects sanctions, denies military strike, confirms deal, plans tariff, welcomes ceasefire"


def _pick(values: str, index: str) -> str:
    items = [v.strip() for v in values.split(",")]
    return "CASE " + index + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(items)) + " END"


HEADLINE = (
    f"concat({_pick(SUBJECTS, 'o_orderkey * 7 % 10')}, ' ', {_pick(VERBS, 'o_custkey * 3 % 10')}, ' in ', {_pick(PLACES, '(o_orderkey + o_custkey) % 12')}, "
    "CASE WHEN o_orderstatus = 'F' THEN concat(', shares of ', substring(upper(md5(CAST(o_custkey AS VARCHAR(20)))), 1, 3), ' gain') ELSE '' END)"
)
HEADLINES = f"""headlines AS (SELECT o_orderkey AS id, {HEADLINE} AS text, 'S' || (o_custkey % 5) AS source, o_orderpriority AS category, o_orderdate AS ts,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'R' || (o_custkey % 9) END AS region FROM orders)"""


def headlines(spark, sf):
    return fx.spread_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.expr(HEADLINE.replace("VARCHAR(20)", "STRING")).alias("text"),
        F.concat(F.lit("S"), F.col("o_custkey") % 5).alias("source"), F.col("o_orderpriority").alias("category"), F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.concat(F.lit("R"), F.col("o_custkey") % 9)).alias("region"),
    )


W = r"[\p{L}\p{N}_]+"


def _found(phrases, whole: bool) -> str:
    parts = []
    for p, v in phrases:
        word = whole and (" " not in p or len(p) <= 4) and "." not in p
        hit = f"list_contains(words, '{p}')" if word else f"contains(low, '{p}')"
        parts.append(f"CASE WHEN {hit} THEN '{v}' END")
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


T1 = r"\b(?:president|prime minister|chancellor|king|queen|prince|princess)\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)"
T2 = r"\b(?:ceo|cfo|chairman|director|minister|secretary|governor|general)\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)"
T3 = r"\b(?:mr\.|mrs\.|ms\.|dr\.|prof\.)\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)"
NOT_TICKERS = ", ".join(f"'{w}'" for w in voc.NO_TICKERS)


def tagged(src: str) -> str:
    return f"""base AS (SELECT id, text, lower(text) AS low, regexp_extract_all(lower(text), '{W}') AS words FROM {src}),
known AS (SELECT id, text, {_found(list(voc.COUNTRIES.items()), True)} AS countries, {_found(list(voc.ORGANISATIONS.items()), False)} AS organisations,
  {_found(list(voc.PERSONS.items()), False)} AS known, list_concat(list_concat(regexp_extract_all(text, '{T1}', 1), regexp_extract_all(text, '{T2}', 1)), regexp_extract_all(text, '{T3}', 1)) AS titled,
  list_filter(regexp_extract_all(text, '{W}'), lambda w: regexp_full_match(w, '[A-Z]{{2,5}}') AND w NOT IN ({NOT_TICKERS})) AS tickers FROM base),
tags AS (SELECT id, countries, organisations, list_concat(known, list_filter(titled, lambda p: length(p) > 3 AND NOT list_contains(known, p))) AS people, tickers FROM known)"""


def _first(c: str) -> str:
    # distinct in order of first appearance
    return f"array_to_string(list_slice(list_filter({c}, lambda x, i: list_position({c}, x) = i), 1, 5), '|') AS {c}"


KINDS = ("countries", "organisations", "people", "tickers")


@query("news_entities", "N1", with_(HEADLINES, tagged("headlines"), f"SELECT id, {', '.join(_first(c) for c in KINDS)} FROM tags"))
def news_entities(spark, sf):
    return ops.extract_entities(headlines(spark, sf), "text").select("id", *[F.array_join(c, "|").alias(c) for c in KINDS])


@query("document_entities", "N1", with_(ARTICLES, tagged("articles"), f"SELECT id, {', '.join(_first(c) for c in KINDS)} FROM tags"))
def document_entities(spark, sf):
    return ops.extract_entities(articles(spark, sf), "text").select("id", *[F.array_join(c, "|").alias(c) for c in KINDS])


@query(
    "news_top_entities",
    "N1",
    with_(
        HEADLINES, tagged("headlines"),
        "long AS (" + " UNION ALL ".join(f"SELECT '{c}' AS kind, unnest({c}) AS name FROM tags" for c in KINDS) + "), "
        "counts AS (SELECT kind, name, count(*) AS mentions FROM long GROUP BY kind, name)",
        "SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY kind ORDER BY mentions DESC, name) <= 10",
    ),
)
def news_top_entities(spark, sf):
    return ops.top_entities(headlines(spark, sf), "text").select("kind", "name", "mentions")


def _weights(text: str) -> str:
    return " + ".join(f"CASE WHEN contains(low, '{p}') THEN {w} ELSE 0 END" for p, w in text.items())


SCORED = f"""w AS (SELECT id, {_weights(voc.POSITIVE)} AS pos, {_weights(voc.NEGATIVE)} AS neg FROM (SELECT id, lower(text) AS low FROM SRC)),
scored AS (SELECT id, pos AS positive_signals, neg AS negative_signals, CASE WHEN pos - neg >= 2 THEN 'BULLISH' WHEN pos - neg <= -2 THEN 'BEARISH' ELSE 'NEUTRAL' END AS sentiment,
  CASE WHEN pos + neg = 0 THEN 0.0::DOUBLE ELSE round((pos - neg)::DOUBLE / (pos + neg), 3) END AS score,
  CASE WHEN pos + neg = 0 THEN 0.2::DOUBLE WHEN abs(pos - neg) >= 2 THEN round(least(0.4::DOUBLE + (pos + neg) * 0.05::DOUBLE, 0.95::DOUBLE), 3) ELSE 0.3::DOUBLE END AS confidence FROM w)"""


@query("news_sentiment", "N2", with_(HEADLINES, SCORED.replace("SRC", "headlines"), "SELECT * FROM scored"))
def news_sentiment(spark, sf):
    return ops.sentiment(headlines(spark, sf), "text").select("id", "positive_signals", "negative_signals", "sentiment", "score", "confidence")


@query("document_sentiment", "N2", with_(ARTICLES, SCORED.replace("SRC", "articles"), "SELECT * FROM scored"))
def document_sentiment(spark, sf):
    return ops.sentiment(articles(spark, sf), "text").select("id", "positive_signals", "negative_signals", "sentiment", "score", "confidence")


@query(
    "news_sentiment_summary",
    "N2",
    with_(HEADLINES, SCORED.replace("SRC", "headlines"), """SELECT count(*) FILTER (sentiment = 'BULLISH') AS bullish, count(*) FILTER (sentiment = 'BEARISH') AS bearish,
  count(*) FILTER (sentiment = 'NEUTRAL') AS neutral, round(avg(score), 3) AS overall_score FROM scored"""),
)
def news_sentiment_summary(spark, sf):
    return ops.sentiment_summary(ops.sentiment(headlines(spark, sf), "text"))


SAME = "CASE w " + " ".join(f"WHEN '{p}' THEN '{v}'" for p, v in list(voc.SYNONYMS.items())) + " ELSE w END"
STOP = ", ".join(f"'{w}'" for w in voc.STOP_WORDS)


@query(
    "news_term_weights",
    "N3",
    with_(
        ARTICLES,
        f"""tok AS (SELECT id, list_transform(list_filter(regexp_extract_all(lower(text), '[a-z]{{3,}}'), lambda w: w NOT IN ({STOP})), lambda w: {SAME}) AS t FROM articles),
terms AS (SELECT id, length(t) AS len, unnest(t) AS term FROM tok), tf AS (SELECT id, len, term, count(*) AS n FROM terms GROUP BY id, len, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)""",
        f"""SELECT id, term, n, {r('n::DOUBLE / len * (ln((SELECT count(*) + 1 FROM articles)::DOUBLE / (df + 1)) + 1)', 9)} AS weight FROM tf JOIN df USING (term)""",
    ),
)
def news_term_weights(spark, sf):
    docs = articles(spark, sf).select("id", ops.tokenise(F.col("text")).alias("tokens"))
    return near(ops.tf_idf(docs, "id", "tokens").select("id", "term", "n", "weight"), "weight", digits=9)


@query("document_topics", "N4")
def document_topics(spark, sf):
    return ops.cluster_semantic(articles(spark, sf), "id", "text", "ts")


@query("headline_topics", "N4")
def headline_topics(spark, sf):
    return ops.cluster_semantic(headlines(spark, sf), "id", "text", "ts")


@query("headline_stories", "N5")
def headline_stories(spark, sf):
    return ops.cluster_stories(headlines(spark, sf), "id", "text", "ts", "category")


@query("story_summary", "N5")
def story_summary(spark, sf):
    h = ops.sentiment(headlines(spark, sf), "text").withColumns({
        "tier": (F.col("id") % 4 + 1).cast("int"), "priority": F.when(F.col("category") == "1-URGENT", "URGENT").otherwise("ROUTINE"),
    })
    return ops.story_summary(ops.cluster_stories(h, "id", "text", "ts", "category").join(h, "id"), F.to_timestamp(F.lit("1998-08-02")))


NOW_SQL = "TIMESTAMP '2024-01-01 06:00:00'"
_TH = [(w, c) for c, ws in voc.THREATS.items() for w in ws]
_SIGNALS = f"""counts AS ({' UNION ALL '.join(f"SELECT '{p}' AS keyword, '{c}' AS category, count(*) FILTER (contains(lower(text), '{p}')) AS mentions FROM SRC" for p, c in _TH)}),
vel AS (SELECT category, count(*) FILTER (epoch(NOW) - epoch(ts) <= 3600) AS recent, greatest(count(*) FILTER (epoch(NOW) - epoch(ts) > 3600), 1) AS older FROM SRC WHERE epoch(NOW) - epoch(ts) <= 7200 GROUP BY category),
tri AS (SELECT substring(lower(text), 1, 50) AS subject, count(DISTINCT source) AS value FROM SRC GROUP BY 1 HAVING count(DISTINCT source) >= 3),
geo AS (SELECT region AS subject, count(*) AS value FROM SRC WHERE region <> '' GROUP BY region HAVING count(*) >= 5 AND count(DISTINCT category) >= 2),
top AS (SELECT * FROM counts ORDER BY mentions DESC, keyword LIMIT 10), sums AS (SELECT sum(mentions) FILTER (category = 'conflict')::DOUBLE AS c, sum(mentions) FILTER (keyword IN ('military', 'troops', 'missile', 'weapon', 'artillery', 'drone'))::DOUBLE AS m FROM counts)"""
_SIGNALS_OUT = """SELECT 'velocity_spike' AS type, category AS subject, category, CASE WHEN recent / older >= 5 THEN 'high' ELSE 'medium' END AS severity, round(recent / older, 1)::DOUBLE AS value FROM vel WHERE recent / older >= 3 AND recent >= 5
UNION ALL SELECT 'triangulation', subject, '', 'medium', value::DOUBLE FROM tri
UNION ALL SELECT 'geo_convergence', subject, '', 'high', value::DOUBLE FROM geo
UNION ALL SELECT 'keyword_spike', keyword, category, CASE WHEN mentions >= 10 THEN 'high' ELSE 'medium' END, mentions::DOUBLE FROM top WHERE mentions >= 5
UNION ALL SELECT 'hotspot_escalation', 'conflict', '', CASE WHEN c >= 20 THEN 'critical' ELSE 'high' END, c FROM sums WHERE c >= 10
UNION ALL SELECT 'military_surge', 'military', '', 'high', m FROM sums WHERE m >= 8"""


@query("news_signals", "N6", with_(ARTICLES, _SIGNALS.replace("SRC", "articles").replace("NOW", NOW_SQL), _SIGNALS_OUT))
def news_signals(spark, sf):
    return ops.detect_signals(articles(spark, sf), "text", F.to_timestamp(F.lit("2024-01-01 06:00:00")))


@query("headline_signals", "N6", with_(HEADLINES, _SIGNALS.replace("SRC", "headlines").replace("NOW", "TIMESTAMP '1997-03-03'"), _SIGNALS_OUT))
def headline_signals(spark, sf):
    return ops.detect_signals(headlines(spark, sf), "text", F.to_timestamp(F.lit("1997-03-03")))


@query(
    "focal_points",
    "N7",
    with_(ARTICLES, """cells AS (SELECT round_even(lat, 0)::INT AS cell_lat, round_even(lon, 0)::INT AS cell_lon, count(*) AS event_count, count(DISTINCT category) AS categories, count(DISTINCT source) AS source_count FROM articles GROUP BY 1, 2)""",
          "SELECT *, CASE WHEN event_count >= 10 THEN 'critical' WHEN event_count >= 5 THEN 'high' ELSE 'medium' END AS severity FROM cells WHERE event_count >= 3"),
)
def focal_points(spark, sf):
    return ops.focal_points(articles(spark, sf))


# Signals per nation, from counts of its customers' orders by priority.
NATION_SIGNALS = """sig AS (SELECT upper(substring(n_name, 1, 2)) AS country, CASE o_orderpriority WHEN '1-URGENT' THEN 'hotspot_escalation' WHEN '2-HIGH' THEN 'velocity_spike' WHEN '3-MEDIUM' THEN 'triangulation' ELSE 'other' END AS type,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'conflict' WHEN 'MACHINERY' THEN 'market' WHEN 'HOUSEHOLD' THEN 'cyber' ELSE '' END AS category,
  CASE o_orderstatus WHEN 'F' THEN 'medium' WHEN 'O' THEN 'low' ELSE 'none' END AS severity, count(*) / 4.0::DOUBLE AS value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)"""


def nation_signals(spark, sf):
    o, c, n = (fx.table(spark, sf, t) for t in ("orders", "customer", "nation"))
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"])  # nation has 25 rows
    p, s, st = F.col("o_orderpriority"), F.col("c_mktsegment"), F.col("o_orderstatus")
    return j.groupBy(
        F.upper(F.substring("n_name", 1, 2)).alias("country"),
        F.when(p == "1-URGENT", "hotspot_escalation").when(p == "2-HIGH", "velocity_spike").when(p == "3-MEDIUM", "triangulation").otherwise("other").alias("type"),
        F.when(s == "BUILDING", "conflict").when(s == "MACHINERY", "market").when(s == "HOUSEHOLD", "cyber").otherwise("").alias("category"),
        F.when(st == "F", "medium").when(st == "O", "low").otherwise("none").alias("severity"),
    ).agg((F.count("*") / 4).alias("value"))


_CAP = "CASE k " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in voc.SIGNAL_CAPS.items()) + " END"


@query(
    "country_instability",
    "N8",
    with_(
        NATION_SIGNALS,
        f"""st AS (SELECT *, value * CASE severity WHEN 'critical' THEN 1.0 WHEN 'high' THEN 0.7 WHEN 'medium' THEN 0.4 WHEN 'low' THEN 0.2 ELSE 0.1 END::DOUBLE AS strength FROM sig),
two AS (SELECT country, type AS k, strength * 5 AS s FROM st UNION ALL SELECT country, category, strength * 3 FROM st),
best AS (SELECT country, k, max(least({_CAP}, s)) AS score FROM two WHERE {_CAP} IS NOT NULL GROUP BY country, k),
tot AS (SELECT country, count(*) AS total_signals FROM sig GROUP BY country),
ix AS (SELECT t.country, CASE WHEN t.country IN ({', '.join(f"'{c}'" for c in voc.STABLE_COUNTRIES)}) THEN 10 ELSE 25 END AS baseline, total_signals,
  coalesce((SELECT sum(score) FROM best b WHERE b.country = t.country), 0) AS extra FROM tot t)""",
        """SELECT country, baseline, total_signals, least(floor(baseline + extra), 100)::INT AS cii_score,
  CASE WHEN least(floor(baseline + extra), 100) >= 75 THEN 'CRITICAL' WHEN floor(baseline + extra) >= 50 THEN 'HIGH' WHEN floor(baseline + extra) >= 30 THEN 'ELEVATED' ELSE 'STABLE' END AS level FROM ix""",
    ),
)
def country_instability(spark, sf):
    return ops.instability(nation_signals(spark, sf), "country")


@query(
    "news_deviations",
    "N6,T11",
    with_(
        """hours AS (SELECT event_type AS category, date_trunc('hour', ts) AS hour, count(*) AS current FROM events GROUP BY 1, 2),
b AS (SELECT *, round(avg(current) OVER p, 2) AS mean, round(stddev_pop(current) OVER p, 2) AS sd, count(*) OVER p AS n FROM hours WINDOW p AS (PARTITION BY category ORDER BY hour ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, (current - mean) / sd AS z FROM b WHERE n >= 24 AND sd >= 0.5)""",
        """SELECT category, hour, current, mean AS baseline_mean, round(z, 2) AS z_score, round(current / greatest(mean, 0.1), 1) AS multiplier,
  CASE WHEN z >= 4 THEN 'critical' WHEN z >= 3 THEN 'high' ELSE 'medium' END AS severity FROM z WHERE z >= 2""",
    ),
)
def news_deviations(spark, sf):
    e = fx.table(spark, sf, "events").select(F.col("event_type").alias("category"), F.col("ts").cast("timestamp").alias("ts"))
    return ops.hourly_baseline(e)


MONITORS = {"energy": ("OPEC", "oil"), "central banks": ("the Fed", "Powell"), "asia": ("tokyo", "South Korea", "china"), "text": ("the", "von", "la")}


def _monitor_sql(src: str) -> str:
    return " UNION ALL ".join(f"""SELECT id, '{n}' AS monitor FROM {src} WHERE regexp_matches(text, '{ops.monitor_pattern(k).replace(chr(92) + " ", " ")}')""" for n, k in MONITORS.items())


@query("news_monitors", "N9", with_(HEADLINES, _monitor_sql("headlines")))
def news_monitors(spark, sf):
    return ops.scan_monitors(headlines(spark, sf), "text", MONITORS).select("id", "monitor")


_BM = """base AS (SELECT id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM articles),
tf AS (SELECT id, length(w) AS len, length(list_filter(w, lambda x: x = 'from')) AS a, length(list_filter(w, lambda x: x = 'with')) AS b FROM base),
tot AS (SELECT count(*) AS n, avg(len) AS mean, count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db FROM tf),
sc AS (SELECT id, greatest(ln((n - da + 0.5) / (da + 0.5)), 1e-6) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * len / mean)) + greatest(ln((n - db + 0.5) / (db + 0.5)), 1e-6) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * len / mean)) AS score FROM tf, tot WHERE a > 0 AND b > 0)"""


@query("news_search", "N10", with_(ARTICLES, _BM, f"SELECT id, {r('score', 9)} AS score FROM sc ORDER BY sc.score DESC, id LIMIT 50"))
def news_search(spark, sf):
    return near(ops.search_ranked(articles(spark, sf).select("id", "text"), "id", "text", "with from", 50).select("id", "score"), "score", digits=9)


@query("news_search_like", "N10", with_(ARTICLES, "SELECT id, source, ts FROM articles WHERE text ILIKE '%ther%' ORDER BY ts DESC LIMIT 50"))
def news_search_like(spark, sf):
    return ops.search_like(articles(spark, sf), "text", "ther", "ts", 50).select("id", "source", "ts")


def _places(src: str) -> str:
    cities, known = [(n, *at) for n, at in voc.CITIES.items()], {p[0] for p in [(n, *at) for n, at in voc.CITIES.items()]}
    rows = [(*p, "city") for p in cities] + [(*p, "country") for p in [(n, *at) for n, at in voc.CENTRES.items()] if p[0] not in known]
    title = lambda s: " ".join(w.capitalize() for w in s.split(" "))
    cases = ", ".join(f"CASE WHEN contains(low, '{n}') THEN {{'name': '{title(n)}', 'lat': {lat}::DOUBLE, 'lon': {lon}::DOUBLE}} END" for n, lat, lon, _ in rows)
    return f"found AS (SELECT id, list_filter([{cases}], lambda x: x IS NOT NULL) AS l FROM (SELECT id, lower(text) AS low FROM {src}))"


@query(
    "news_places",
    "N11",
    with_(HEADLINES, _places("headlines"), "SELECT id, l[1].lat AS primary_lat, l[1].lon AS primary_lon, array_to_string(list_transform(list_slice(l, 1, 5), lambda x: x.name), '|') AS places FROM found WHERE length(l) > 0"),
)
def news_places(spark, sf):
    g = ops.geocode(headlines(spark, sf), "text")
    return g.select("id", "primary_lat", "primary_lon", F.array_join(F.transform("locations", lambda x: x["name"]), "|").alias("places"))


# One filing per order: a text with stated value, date, premium, payment and synergies.
FILING = """concat(CASE o_orderkey % 4 WHEN 0 THEN 'Item 2.01 Completion of acquisition. ' WHEN 1 THEN 'Item 5.02 Board changes. ' WHEN 2 THEN 'A definitive merger agreement and stock purchase agreement for the acquisition, a business combination, entered into as of March 14, 1997, ' ELSE 'Tender offer effective 7/4/1996 ' END,
 CASE o_orderkey % 3 WHEN 0 THEN concat('for an aggregate purchase price of $ ', CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR(20)), ' ') WHEN 1 THEN concat('for $', CAST(o_custkey % 90 + 1 AS VARCHAR(20)), '.5 billion ') ELSE concat('with consideration of $', CAST(o_custkey % 900 + 100 AS VARCHAR(20)), ' million ') END,
 CASE o_custkey % 4 WHEN 0 THEN 'in cash and stock, ' WHEN 1 THEN 'in cash, ' WHEN 2 THEN 'by exchange ratio in common stock, ' ELSE '' END,
 CASE o_custkey % 3 WHEN 0 THEN concat('a ', CAST(o_orderkey % 60 AS VARCHAR(20)), '.25% premium to the closing share price ') WHEN 1 THEN concat('a premium of approximately ', CAST(o_orderkey % 300 AS VARCHAR(20)), '% ') ELSE 'a 12.5% premium over the prior four week average ' END,
 CASE WHEN o_custkey % 5 = 0 THEN concat('and cost savings of $', CAST(o_orderkey % 70 + 1 AS VARCHAR(20)), ' million, ') ELSE '' END,
 CASE o_orderstatus WHEN 'F' THEN 'completed.' WHEN 'O' THEN 'subject to approval.' ELSE 'announced today.' END)"""
FORM = "CASE o_orderkey % 6 WHEN 0 THEN '8-K' WHEN 1 THEN 'S-4' WHEN 2 THEN 'DEFM14A' WHEN 3 THEN '425' WHEN 4 THEN '10-K' ELSE '8-K' END"
FILINGS = f"filings AS (SELECT o_orderkey AS id, {FILING} AS text, {FORM} AS form, o_orderdate::DATE AS filed FROM orders)"


def filings(spark, sf):
    return fx.spread_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.expr(FILING.replace("VARCHAR(20)", "STRING")).alias("text"), F.expr(FORM).alias("form"), F.to_date("o_orderdate").alias("filed"),
    )


def _count(tests) -> str:
    return "(" + " + ".join(f"CASE WHEN {t} THEN 1 ELSE 0 END" for t in tests) + ")"


_SCORE = f"""least(CASE WHEN form IN {tuple(voc.SURE_FORMS)} THEN 0.45 WHEN form IN {tuple(voc.LIKELY_FORMS)} THEN 0.15 ELSE 0 END
  + least({_count(f"contains(low, '{w}')" for w in voc.DEAL_WORDS)} * 0.07, 0.35) + {_count(f"regexp_matches(low, '{p}')" for p in voc.DEAL_PATTERNS)} * 0.10
  + CASE WHEN form = '8-K' AND list_has_any(regexp_extract_all(text, 'Item\\s+(\\d+\\.\\d+)', 1), ['1.01', '2.01', '8.01']) THEN 0.20 ELSE 0 END, 1.0)::DOUBLE"""


@query("filing_scan", "N12", with_(FILINGS, f"s AS (SELECT id, form, {r(_SCORE, 6)} AS confidence FROM (SELECT *, lower(text) AS low FROM filings))", "SELECT * FROM s WHERE confidence >= 0.75"))
def filing_scan(spark, sf):
    return near(ops.scan_filings(filings(spark, sf), "text", "form").select("id", "form", "confidence"), "confidence")


def _value_sql() -> str:
    parts = []
    for p in voc.DEAL_VALUES:
        whole, num = f"lower(regexp_extract(text, '(?i){p}', 0))", f"TRY_CAST(replace(regexp_extract(text, '(?i){p}', 1), ',', '') AS DOUBLE)"
        parts.append(f"CASE WHEN {whole} <> '' THEN CASE WHEN contains({whole}, 'billion') OR contains({whole}, 'bn') THEN {num} * 1e9 WHEN contains({whole}, 'million') THEN {num} * 1e6 WHEN {num} > 1e6 THEN {num} WHEN {num} > 1e3 THEN {num} * 1e6 ELSE {num} * 1e9 END END")
    return f"coalesce({', '.join(parts)})"


def _premium_sql(patterns) -> str:
    nums = [f"TRY_CAST(regexp_extract(text, '(?i){p}', 1) AS DOUBLE)" for p in patterns]
    return "coalesce(" + ", ".join(f"CASE WHEN {n} > 0 AND {n} < 200 THEN {n} END" for n in nums) + ")"


def _occurs(words) -> str:
    return "(" + " + ".join(f"((length(low) - length(replace(low, '{w}', ''))) // {len(w)})" for w in words) + ")"


def _synergy_sql() -> str:
    return "coalesce(" + ", ".join(
        f"CASE WHEN regexp_extract(text, '(?i){p}', 0) <> '' THEN TRY_CAST(regexp_extract(text, '(?i){p}', 1) AS DOUBLE) * CASE WHEN contains(lower(regexp_extract(text, '(?i){p}', 0)), 'billion') THEN 1e9 ELSE 1e6 END END"
        for p in voc.SYNERGIES
    ) + ")"


@query(
    "filing_deals",
    "N12",
    with_(
        FILINGS,
        f"""f AS (SELECT *, lower(text) AS low FROM filings), p AS (SELECT *, {_occurs(voc.PAID_IN_CASH)} AS cash, {_occurs(voc.PAID_IN_STOCK)} AS stock, {_occurs(voc.PAID_IN_BOTH)} AS mixed FROM f)""",
        f"""SELECT id, {_value_sql()} AS deal_value,
  coalesce(TRY_CAST(try_strptime(regexp_extract(text, '(?:dated|entered\\s+into|effective)\\s+(?:as\\s+of\\s+)?(\\w+\\s+\\d{{1,2}},\\s*\\d{{4}})', 1), '%B %d, %Y') AS DATE),
    TRY_CAST(try_strptime(regexp_extract(text, '(\\d{{1,2}}/\\d{{1,2}}/\\d{{4}})', 1), '%m/%d/%Y') AS DATE), filed) AS announced,
  CASE WHEN mixed > 0 OR (cash > 0 AND stock > 0) THEN 'Mixed' WHEN cash > stock THEN 'Cash' WHEN stock > 0 THEN 'Stock' ELSE 'Cash' END AS payment,
  CASE WHEN contains(low, 'merger of equals') OR contains(low, 'merger agreement') THEN 'Merger' WHEN contains(low, 'tender offer') THEN 'Takeover' WHEN contains(low, 'asset purchase') OR contains(low, 'sale of assets') THEN 'Asset Purchase' WHEN contains(low, 'joint venture') THEN 'Joint Venture' ELSE 'Acquisition' END AS deal_type,
  CASE WHEN form IN ('DEFM14A', 'PREM14A') THEN 'Pending' WHEN regexp_matches(low, 'closed|completed|consummated') THEN 'Completed' WHEN regexp_matches(low, 'terminated|abandoned') THEN 'Terminated' WHEN regexp_matches(low, 'pending|subject to') THEN 'Pending' ELSE 'Announced' END AS status,
  {_premium_sql(voc.PREMIUM_1DAY)} AS premium_1day, {_premium_sql(voc.PREMIUM_1WEEK)} AS premium_1week, {_premium_sql(voc.PREMIUM_4WEEK)} AS premium_4week, {_synergy_sql()} AS synergies FROM p""",
    ),
)
def filing_deals(spark, sf):
    return ops.deal_fields(filings(spark, sf), "text", "form", "filed").drop("text", "form", "filed")
