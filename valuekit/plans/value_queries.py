"""Names, matching, dated values, features and valuation gaps bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from valuekit.functions import fuzzy, numbers, paths, text
from valuekit.functions.features import features
from valuekit.operators import analysis, clean, collapse, enrich, match, windows
from valuekit.plans import players
from valuekit.plans.registry import long, query, r4, sql_r4
from valuekit.plans.table_queries import LINE_ORDER, SQL_LINE_ORDER, line_order
from valuekit.session import fresh_path
from valuekit.sources import readers, writers

# ---- names -------------------------------------------------------------------------------------


def document_words(t):
    """Every distinct word of all documents, with its number of uses."""
    words = t("documents").select(F.explode(F.split("text", r"\s+")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("uses"))


SQL_WORDS = r"words AS (SELECT word, count(*) AS uses FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents) GROUP BY 1)"
SQL_KEY = r"regexp_replace(lower(replace(strip_accents(trim({0})), 'ß', 'ss')), '[-''\s]', '', 'g')"
SQL_SPACED = r"trim(regexp_replace(regexp_replace(strip_accents(lower(trim({0}))), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g'))"


@query("repair_mojibake", "SELECT doc_id, md5(text) AS digest, length(text) AS n_chars FROM documents")
def repair_mojibake(t):
    """Each document's UTF-8 read as Latin-1, then repaired."""
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    repaired = text.repair_mojibake(broken)
    return t("documents").select("doc_id", F.md5(repaired).alias("digest"), long(F.length(repaired)).alias("n_chars"))


@query("strip_accents", f"WITH {SQL_WORDS} SELECT word, strip_accents(word) AS folded, uses FROM words")
def strip_accents(t):
    return document_words(t).select("word", text.strip_accents(F.col("word")).alias("folded"), "uses")


@query("name_key", f"SELECT doc_id, md5({SQL_KEY.format('text')}) AS digest FROM documents")
def name_key(t):
    return t("documents").select("doc_id", F.md5(text.name_key(F.col("text"))).alias("digest"))


@query("name_key_spaced", f"SELECT doc_id, md5({SQL_SPACED.format('text')}) AS digest FROM documents")
def name_key_spaced(t):
    return t("documents").select("doc_id", F.md5(text.name_key_spaced(F.col("text"))).alias("digest"))


SQL_LAST_WORD = r"regexp_extract(trim(text), '[^\s]+$')"


@query("last_name", f"SELECT doc_id, {SQL_KEY.format(SQL_LAST_WORD)} AS last_name FROM documents")
def last_name(t):
    return t("documents").select("doc_id", text.last_name(F.col("text")).alias("last_name"))


def part_names(t):
    """Names of two to four words, some hyphenated."""
    name = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).when(
        F.col("p_partkey") % 3 == 1, F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(" "), "p_type")
    ).otherwise(F.concat_ws(" ", "p_name", "p_type", "p_brand"))
    return t("part").select("p_partkey", name.alias("name"))


SQL_PART_NAMES = """names AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '-') || ' ' || p_type
    ELSE p_name || ' ' || p_type || ' ' || p_brand END AS name FROM part)"""


def sql_cases(x: str) -> str:
    bare = r"regexp_replace({0}, '[^\p{{L}}\p{{N}}_\s]', '', 'g')"
    return f"[{x}, lower({x}), {bare.format(x)}, {bare.format(f'lower({x})')}]"


def sql_variants(n: str) -> str:
    """Spellings of a plain ASCII name, in their order."""
    w = f"string_split({n}, ' ')"
    last = f"{w}[-1]"
    hyphenated = f"({w}[1] || '-' || {w}[2] || ' ' || array_to_string({w}[3:], ' '))"
    swapped, initial = f"({w}[2] || ' ' || {w}[1])", f"({w}[1][1] || ' ' || {last})"
    return " || ".join(
        [
            sql_cases(n), sql_cases(f"replace({n}, '-', ' ')"), f"[{SQL_KEY.format(n)}, {SQL_SPACED.format(n)}]",
            f"CASE WHEN len({w}) = 2 THEN {sql_cases(swapped)} ELSE [] END",
            f"CASE WHEN len({w}) >= 3 THEN {sql_cases(hyphenated)} ELSE [] END",
            f"CASE WHEN len({w}) >= 2 THEN {sql_cases(initial)} ELSE [] END",
            sql_cases(last), f"[{SQL_KEY.format(last)}, {SQL_SPACED.format(last)}]",
        ]
    )


@query(
    "candidate_variants",
    f"WITH {SQL_PART_NAMES}, v AS (SELECT p_partkey, list_sort(list_distinct({sql_variants('name')})) AS l FROM names) SELECT p_partkey, len(l) AS n_variants, array_to_string(l, '|') AS variants FROM v",
)
def candidate_variants(t):
    sorted_variants = F.sort_array(text.name_variants(F.col("name")))
    return part_names(t).select("p_partkey", long(F.size(sorted_variants)).alias("n_variants"), F.array_join(sorted_variants, "|").alias("variants"))


@query(
    "parse_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 1, 2) THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def parse_date(t):
    key, iso = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = F.when(key % 5 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).when(key % 5 == 1, "2022-13-40").when(key % 5 == 2, None).otherwise(iso)
    return t("orders").select("o_orderkey", text.parse_date(raw).cast("string").alias("day"))


@query(
    "slugify",
    """WITH s AS (SELECT p_partkey, lower(replace(p_name, ' ', '-') || '-' || replace(p_brand, '#', '') || '-' || p_type) AS slug FROM part)
       SELECT p_partkey, slug, 'https://example.org/' || slug || '/profil/spieler/' || p_partkey::VARCHAR AS url FROM s""",
)
def slugify(t):
    name = F.concat(F.lit(" "), "p_name", F.lit("  "), "p_brand", F.lit(" -- "), "p_type")
    return t("part").select("p_partkey", text.slug(name).alias("slug"), text.profile_url(name, F.col("p_partkey"), "https://example.org/").alias("url"))


# Scores of CTE ``pairs(a, b)``: every stretch of the longer text against the shorter one, longest common
# subsequence row by row.
SQL_SCORES = """ways AS (SELECT a, b, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS s, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS t FROM pairs
      UNION SELECT a, b, b, a FROM pairs WHERE length(a) = length(b)),
    cuts AS (SELECT a, b, s, substr(t, greatest(i, 0) + 1, least(i + length(s), length(t)) - greatest(i, 0)) AS w
      FROM ways, generate_series(-60, 60) AS g(i) WHERE i BETWEEN 1 - length(s) AND length(t) - 1),
    dp AS (SELECT DISTINCT s, w, 0 AS n, [0 FOR x IN range(0, length(s) + 1)] AS r FROM cuts
      UNION ALL SELECT s, w, n + 1, [greatest(r[j + 1], coalesce(list_max([r[k] + 1 FOR k IN range(1, j + 1) IF s[k] = w[n + 1]]), 0)) FOR j IN range(0, length(s) + 1)]
      FROM dp WHERE n < length(w)),
    scores AS (SELECT a, b, max(200.0 * r[-1] / (length(s) + length(w))) AS score FROM cuts JOIN dp USING (s, w) WHERE n = length(w) GROUP BY a, b)"""


@query(
    "partial_ratio",
    f"""WITH RECURSIVE names AS (SELECT DISTINCT p_name, p_type FROM part), pairs AS (SELECT DISTINCT lower(p_name) AS a, lower('ring ' || p_type) AS b FROM names), {SQL_SCORES}
        SELECT p_name, p_type, {sql_r4('score')} AS score FROM names JOIN scores ON a = lower(p_name) AND b = lower('ring ' || p_type)""",
)
def partial_ratio(t):
    pairs = t("part").select("p_name", "p_type").distinct()
    return pairs.withColumn("score", r4(fuzzy.partial_ratio(F.col("p_name"), F.concat_ws(" ", F.lit("ring"), "p_type"))))


# ---- matching ----------------------------------------------------------------------------------


@query(
    "normalized_join",
    """WITH f AS (SELECT p_name, p_retailprice FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1)
       SELECT p.p_partkey, CASE WHEN p.p_partkey % 10 > 0 THEN f.p_retailprice END AS price FROM part p JOIN f USING (p_name)""",
)
def normalized_join(t):
    shown = F.upper(F.replace("p_name", F.lit(" "), F.lit("-")))
    left = t("part").select("p_partkey", F.when(F.col("p_partkey") % 10 == 0, "zzz").otherwise(shown).alias("player"))
    right = t("part").select(F.col("p_name").alias("player"), F.col("p_retailprice").alias("price"), F.col("p_partkey").alias("seq"))
    return match.join_on_name(left, right, "player", ["price"], [F.col("seq")]).select("p_partkey", "price")


def part_index(t):
    """Parts as search results; a third of them have no value."""
    value = F.when(F.col("p_partkey") % 3 == 0, 0.0).otherwise(F.col("p_retailprice"))
    return t("part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("club"), value.alias("market_value"), F.col("p_size").alias("result_rank"),
    )


SQL_LISTED = """listed AS (SELECT key, arg_min(p_partkey, ((p_partkey % 3 = 0)::INT, p_size, p_partkey)) AS id FROM
    (SELECT *, unnest([p_name, replace(p_name, ' ', '')]) AS key FROM part) GROUP BY 1)"""


@query("first_match", f"WITH {SQL_LISTED} SELECT key, id FROM listed")
def first_match(t):
    return match.listed_under(part_index(t))


SQL_WANTED = """wanted AS (SELECT DISTINCT CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN string_split(p_name, ' ')[2] || ' ' || string_split(p_name, ' ')[1]
    WHEN 2 THEN upper(p_name) WHEN 3 THEN replace(p_name, ' ', '-') WHEN 4 THEN 'the ' || p_name ELSE 'zz ' || p_type END AS name FROM part)"""


def wanted_names(t):
    """Part names as they are, swapped, upper case, hyphenated, with an extra word, and names nobody has."""
    words = F.split("p_name", " ")
    kinds = [
        F.col("p_name"), F.concat_ws(" ", words[1], words[0]), F.upper("p_name"), F.replace("p_name", F.lit(" "), F.lit("-")),
        F.concat(F.lit("the "), "p_name"), F.concat(F.lit("zz "), "p_type"),
    ]
    name = kinds[-1]
    for i, kind in enumerate(kinds[:-1]):
        name = F.when(F.col("p_partkey") % 6 == i, kind).otherwise(name)
    return t("part").select(name.alias("name"), F.col("p_brand").alias("team"))


SQL_DIRECT = r"""[name, regexp_replace(name, '[^\w\s]', '', 'g')] || CASE WHEN contains(name, '-') THEN [replace(name, '-', ' ')] ELSE [] END
    || CASE WHEN len(string_split(name, ' ')) >= 3 THEN [string_split(name, ' ')[1] || '-' || string_split(name, ' ')[2] || ' ' || array_to_string(string_split(name, ' ')[3:], ' '),
         string_split(name, ' ')[1] || string_split(name, ' ')[2] || ' ' || array_to_string(string_split(name, ' ')[3:], ' ')] ELSE [] END
    || CASE WHEN len(string_split(name, ' ')) = 2 THEN [string_split(name, ' ')[2] || ' ' || string_split(name, ' ')[1]] ELSE [] END
    || CASE WHEN lower(name) <> name THEN [lower(name), regexp_replace(lower(name), '[^\w\s]', '', 'g')] ELSE [] END"""


@query(
    "candidate_cascade",
    f"""WITH {SQL_LISTED}, {SQL_WANTED}, l AS (SELECT name, {SQL_DIRECT} || {sql_variants('name')} AS tries FROM wanted),
        tried AS (SELECT name, i, tries[i] AS key FROM l, generate_series(1, 60) AS s(i) WHERE i <= len(tries))
        SELECT name, arg_min(id, i) AS id FROM tried JOIN listed USING (key) GROUP BY 1""",
)
def candidate_cascade(t):
    return match.match_by_spelling(wanted_names(t), part_index(t), "name")


@query(
    "lastname_fuzzy",
    f"""WITH RECURSIVE {SQL_WANTED.replace("AS name FROM part)", "AS name, 'Fc ' || replace(p_brand, '#', '') AS team FROM part)")},
        people AS (SELECT name, team, {SQL_KEY.format("string_split(name, ' ')[-1]")} AS last FROM wanted),
        clubs AS (SELECT string_split(p_name, ' ')[-1] AS last, p_brand AS club, min((p_size, p_partkey)) AS entry FROM part GROUP BY 1, 2),
        met AS (SELECT DISTINCT last, team, club, entry FROM people JOIN clubs USING (last)),
        pairs AS (SELECT DISTINCT lower(team) AS a, lower(club) AS b FROM met), {SQL_SCORES},
        best AS (SELECT last, team, entry, score FROM met JOIN scores ON a = lower(team) AND b = lower(club) WHERE score >= 80
                 QUALIFY row_number() OVER (PARTITION BY last, team ORDER BY score DESC, entry) = 1)
        SELECT name, team, struct_extract(entry, 2) AS id, {sql_r4('score')} AS score FROM people JOIN best USING (last, team)""",
)
def lastname_fuzzy(t):
    people = wanted_names(t).withColumn("team", F.concat_ws(" ", F.lit("Fc"), F.replace("team", F.lit("#"), F.lit(""))))
    return match.match_by_last_name(people, part_index(t), "name", "team").withColumn("score", r4(F.col("score")))


def customer_index(t):
    key = F.col("c_custkey")
    return t("customer").select(key.alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("club"), F.col("c_acctbal").alias("market_value"), key.alias("result_rank"))


def order_history(t):
    """Each customer's orders as a value history; the priority plays the club."""
    return t("orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("position"), F.to_date("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("club"), F.col("o_totalprice").alias("value"),
    )


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def customer_seasons(t):
    """Customers under spellings of their name, each in a team and a season; every fourth is a stranger."""
    key = F.col("c_custkey")
    name = F.when(key % 4 == 0, F.col("c_name")).when(key % 4 == 1, F.upper("c_name")).when(
        key % 4 == 2, F.replace("c_name", F.lit("#"), F.lit(" "))
    ).otherwise(F.concat_ws(" ", F.lit("Stranger"), key))
    team = F.get(F.array(*map(F.lit, PRIORITIES)), (key % 5).cast("int"))
    return t("customer").select(key.alias("c_custkey"), name.alias("player"), team.alias("squad"), (1996 + key % 6).cast("int").alias("season_end"))


SQL_SEASONS = f"""seasons AS (SELECT c_custkey, {PRIORITIES!r}[1 + c_custkey % 5] AS squad, 1996 + c_custkey % 6 AS season_end FROM customer),
    near AS (SELECT c_custkey, squad, season_end, arg_min(o_totalprice, (make_date(season_end, 6, 30) - o_orderdate::DATE, o_orderkey)) AS value
      FROM seasons JOIN orders ON o_custkey = c_custkey AND o_orderpriority = squad
       AND o_orderdate::DATE BETWEEN make_date(season_end - 1, 7, 1) AND make_date(season_end, 6, 30) GROUP BY ALL),
    early AS (SELECT o_custkey AS c_custkey, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_value FROM orders GROUP BY 1)"""


@query(
    "season_interval",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1996-07-01' AND DATE '1997-06-30'""",
)
def season_interval(t):
    inside = enrich.in_season(order_history(t), 1997)
    return inside.select(F.col("position").alias("o_orderkey"), F.col("id").alias("o_custkey"))


@query(
    "nearest_value",
    f"""WITH {SQL_SEASONS} SELECT c_custkey, squad, season_end, {sql_r4('coalesce(value, first_value)')} AS value,
        CASE WHEN value IS NOT NULL THEN 'season_club' WHEN first_value IS NOT NULL THEN 'earliest' ELSE 'none' END AS match_kind
        FROM seasons LEFT JOIN near USING (c_custkey, squad, season_end) LEFT JOIN early USING (c_custkey)""",
)
def nearest_value(t):
    picked = enrich.pick_value(customer_seasons(t), order_history(t), "c_custkey", "squad", "season_end")
    return picked.withColumn("value", r4(F.col("value"))).withColumn("season_end", long(F.col("season_end")))


@query(
    "enrich_left",
    f"""WITH {SQL_SEASONS} SELECT c_custkey, season_end, CASE WHEN c_custkey % 4 < 3 THEN {sql_r4('coalesce(value, first_value)')} END AS value
        FROM seasons LEFT JOIN near USING (c_custkey, squad, season_end) LEFT JOIN early USING (c_custkey)""",
)
def enrich_left(t):
    rows = customer_seasons(t)
    matches = match.match_entities(rows, customer_index(t), "player", "squad")
    valued = enrich.enrich(rows, matches, order_history(t))
    return valued.select("c_custkey", long(F.col("season_end")).alias("season_end"), r4(F.col("`Market Value`")).alias("value"))


@query(
    "full_history",
    "SELECT c_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_totalprice AS value FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_custkey % 4 < 3",
)
def full_history(t):
    rows = customer_seasons(t)
    matches = match.match_entities(rows, customer_index(t), "player", "squad")
    flat = enrich.full_history(rows, matches, order_history(t))
    return flat.select(F.col("id").alias("c_custkey"), F.col("position").alias("o_orderkey"), F.col("date").cast("string").alias("day"), "value")


# ---- features ----------------------------------------------------------------------------------


@query("safe_ratio", f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_suppkey, {sql_r4('l_tax / nullif(l_discount, 0)')} AS ratio FROM lineitem")
def safe_ratio(t):
    ratio = numbers.safe_ratio(F.col("l_tax"), F.col("l_discount"))
    return t("lineitem").select("l_orderkey", long(F.col("l_linenumber")).alias("l_linenumber"), "l_suppkey", r4(ratio).alias("ratio"))


@query("round_half_even", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_suppkey, round_even(l_extendedprice / l_quantity * 100, 0) / 100 AS price FROM lineitem")
def round_half_even(t):
    price = numbers.round_half_even(F.col("l_extendedprice") / F.col("l_quantity"))
    return t("lineitem").select("l_orderkey", long(F.col("l_linenumber")).alias("l_linenumber"), "l_suppkey", price.alias("price"))


@query("log_target", f"SELECT o_orderkey, {sql_r4('ln(1 + o_totalprice)')} AS log_price, {sql_r4('o_totalprice')} AS price FROM orders")
def log_target(t):
    logged = numbers.log_target(F.col("o_totalprice"))
    return t("orders").select("o_orderkey", r4(logged).alias("log_price"), r4(numbers.unlog_target(logged)).alias("price"))


# Stand-ins for the player columns, summed per part.
PART_STATS = {
    "matches_played": "count(*)", "minutes_played": "sum(l_quantity)", "90s_played": "sum(l_quantity) / 90",
    "starts": "sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END)", "goals": "sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END)",
    "assists": "sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)", "expected_goals": "sum(l_discount) * 10", "expected_assists": "sum(l_tax) * 10",
    "penalty_kicks_made": "sum(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END)", "penalty_kicks_attempted": "sum(CASE WHEN l_linenumber <= 2 THEN 1 ELSE 0 END)",
    "yellow_cards": "sum(CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END)", "red_cards": "sum(CASE WHEN l_linenumber = 4 THEN 1 ELSE 0 END)",
    "goals_per_90": "sum(l_tax)", "assists_per_90": "sum(l_discount)", "xg_per_90": "max(l_tax)", "xag_per_90": "min(l_discount)",
    "goals_+_assists_per_90": "sum(l_tax) + sum(l_discount)", "xg_+_xag_per_90": "max(l_tax) + min(l_discount)",
    "goals_+_assists_-_penalties_per_90": "sum(l_tax) - 1", "non-penalty_xg_+_xag_per_90": "max(l_discount)",
    "progressive_carries": "sum(CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE 0 END)", "progressive_passes": "sum(CASE WHEN l_suppkey % 3 = 1 THEN 1 ELSE 0 END)",
    "progressive_receives": "sum(CASE WHEN l_linenumber = 5 THEN 1 ELSE 0 END)",
}
SQL_STATS = "stats AS (SELECT l_partkey, " + ", ".join(f'({e})::DOUBLE AS "{c}"' for c, e in PART_STATS.items()) + " FROM lineitem GROUP BY 1)"
SQL_BASIC = {
    "minutes_per_match": "minutes_played / nullif(matches_played, 0)", "minutes_played_ratio": "minutes_played / nullif(matches_played * 90, 0)",
    "start_rate": "starts / nullif(matches_played, 0)", "nineties_per_match": '"90s_played" / nullif(matches_played, 0)',
    "goal_overperformance": "goals - expected_goals", "assist_overperformance": "assists - expected_assists",
    "overall_overperformance": "(goals + assists) - (expected_goals + expected_assists)",
}
SQL_ADVANCED = {
    **SQL_BASIC,
    "assist_to_goal_ratio": "assists / nullif(goals, 0)", "penalty_conversion_rate": "penalty_kicks_made / nullif(penalty_kicks_attempted, 0)",
    "discipline_score": "yellow_cards + 3 * red_cards", "finishing_efficiency": "goals / nullif(expected_goals, 0)",
    "assisting_efficiency": "assists / nullif(expected_assists, 0)",
    "overall_efficiency": "(goals + assists) / nullif(expected_goals + expected_assists, 0)", "goal_ratio": "goals / nullif(goals + assists, 0)",
    "per90_goal_diff": "goals_per_90 - xg_per_90", "conversion_rate_per90": "goals_per_90 / nullif(xg_per_90, 0)",
    "per90_assist_diff": "assists_per_90 - xag_per_90", "assist_conversion_per90": "assists_per_90 / nullif(xag_per_90, 0)",
    "per90_overall_diff": '"goals_+_assists_per_90" - "xg_+_xag_per_90"',
    "non_penalty_overperformance": '"goals_+_assists_-_penalties_per_90" - "non-penalty_xg_+_xag_per_90"',
    "penalty_impact": '"goals_+_assists_per_90" - "goals_+_assists_-_penalties_per_90"',
    "progressive_total": "progressive_carries + progressive_passes + progressive_receives",
    "progressive_actions_per_match": "(progressive_carries + progressive_passes + progressive_receives) / nullif(matches_played, 0)",
    **{
        f"progressive_{x}_ratio": f"progressive_{x} / nullif(progressive_carries + progressive_passes + progressive_receives, 0)"
        for x in ("carries", "passes", "receives")
    },
}


def part_stats(t):
    return t("lineitem").groupBy("l_partkey").agg(*[F.expr(e).cast("double").alias(c) for c, e in PART_STATS.items()])


def sql_features(formulas):
    return f"WITH {SQL_STATS} SELECT l_partkey, " + ", ".join(f"{sql_r4(e)} AS {c}" for c, e in formulas.items()) + " FROM stats"


@query("features_basic", sql_features(SQL_BASIC))
def features_basic(t):
    return features(part_stats(t), players.BASIC).select("l_partkey", *[r4(F.col(c)).alias(c) for c in players.BASIC])


@query("features_enhanced", sql_features(SQL_ADVANCED))
def features_enhanced(t):
    return features(part_stats(t), players.ADVANCED).select("l_partkey", *[r4(F.col(c)).alias(c) for c in players.ADVANCED])


# ---- gaps and evaluation -----------------------------------------------------------------------


def part_gaps(t):
    """Retail price against the mean unit price of the part's line items; some actual prices are 0, two predictions missing."""
    unit = F.sum("l_extendedprice") / F.sum("l_quantity") * (0.3 + F.col("l_partkey") % 7 / 10.0)
    predicted = t("lineitem").groupBy("l_partkey").agg(F.when(F.col("l_partkey") > 1, unit).alias("predicted"))
    actual = t("part").select("p_partkey", "p_name", F.when(F.col("p_partkey") % 50 == 0, 0.0).otherwise(F.col("p_retailprice")).alias("actual"))
    joined = actual.join(predicted, F.col("p_partkey") == F.col("l_partkey"), "left").drop("l_partkey")
    return analysis.valuation_gap(joined, "actual", "predicted")


SQL_GAPS = """gaps AS (SELECT p_partkey, p_name, actual, predicted, predicted - actual AS error, abs(predicted - actual) AS abs_diff,
      abs((predicted - actual) / nullif(actual, 0) * 100) AS pct_diff
    FROM (SELECT p_partkey, p_name, CASE WHEN p_partkey % 50 = 0 THEN 0.0 ELSE p_retailprice END AS actual FROM part)
    LEFT JOIN (SELECT l_partkey, CASE WHEN l_partkey > 1 THEN sum(l_extendedprice) / sum(l_quantity) * (0.3 + l_partkey % 7 / 10.0) END AS predicted FROM lineitem GROUP BY 1) ON l_partkey = p_partkey)"""
SQL_GAP_COLUMNS = ", ".join(["p_partkey", *[f"{sql_r4(c)} AS {c}" for c in ("actual", "predicted", "error", "abs_diff", "pct_diff")]])


def shown(gaps):
    return gaps.select("p_partkey", *[r4(F.col(c)).alias(c) for c in ("actual", "predicted", "error", "abs_diff", "pct_diff")])


@query("valuation_gap", f"WITH {SQL_GAPS} SELECT {SQL_GAP_COLUMNS} FROM gaps")
def valuation_gap(t):
    return shown(part_gaps(t))


def _top(name, report, order, where="TRUE"):
    @query(name, f"WITH {SQL_GAPS}, top AS (SELECT * FROM gaps WHERE {where} ORDER BY {order}, p_partkey LIMIT 5) SELECT {SQL_GAP_COLUMNS} FROM top")
    def top(t):
        return shown(analysis.gap_reports(part_gaps(t), 5, [F.col("p_partkey")])[report])


_top("top_abs_diff", "absolute", "abs_diff DESC NULLS LAST")
_top("top_pct_diff", "percentage", "pct_diff DESC NULLS LAST")
_top("top_undervalued", "undervalued", "error ASC", "error < 0")
_top("top_overvalued", "overvalued", "error DESC", "error > 0")


@query(
    "top_per_group",
    """SELECT l_returnflag, l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_suppkey, l_extendedprice FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey) <= 5""",
)
def top_per_group(t):
    tie = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_suppkey")]
    top = windows.top_k(t("lineitem"), F.col("l_extendedprice"), 5, tie=tie, by=["l_returnflag"])
    return top.select("l_returnflag", "l_orderkey", long(F.col("l_linenumber")).alias("l_linenumber"), "l_suppkey", "l_extendedprice")


SQL_METRICS = ", ".join(
    f"{sql_r4(e)} AS {n}"
    for n, e in {
        "rmse": "sqrt(avg((y - p) * (y - p)))", "r2": "1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))", "mae": "avg(abs(y - p))",
        "medae": "median(abs(y - p))", "mape": "avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)) * 100",
    }.items()
)
METRICS = ("rmse", "r2", "mae", "medae", "mape")


@query("regression_metrics", f"SELECT l_returnflag, count(*) AS n_rows, {SQL_METRICS} FROM (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 1500 * (1 - l_tax) AS p FROM lineitem) GROUP BY 1")
def regression_metrics(t):
    scored = t("lineitem").withColumn("p", F.col("l_quantity") * 1500 * (1 - F.col("l_tax")))
    metrics = analysis.regression_metrics(scored, "l_extendedprice", "p", ["l_returnflag"])
    return metrics.select("l_returnflag", "n_rows", *[r4(F.col(m)).alias(m) for m in METRICS])


SQL_MODEL_PARTS = """m AS (SELECT model, CASE WHEN l_orderkey % 2 = 0 THEN 'Validation' ELSE 'Test' END AS dataset, l_extendedprice AS y,
    l_quantity * factor AS p FROM lineitem, (VALUES ('Linear Regression', 1400.0), ('Random Forest', 1500.0), ('XGBoost', 1600.0)) AS v(model, factor))"""


@query(
    "model_comparison",
    f"WITH {SQL_MODEL_PARTS} SELECT model, dataset, {sql_r4('avg(abs(y - p))')} AS mae, {sql_r4('avg((y - p) * (y - p))')} AS mse, {sql_r4('sqrt(avg((y - p) * (y - p)))')} AS rmse, {sql_r4('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))')} AS r2 FROM m GROUP BY 1, 2",
)
def model_comparison(t):
    factors = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(f).alias("factor")) for m, f in (("Linear Regression", 1400.0), ("Random Forest", 1500.0), ("XGBoost", 1600.0))])
    scored = t("lineitem").select("l_orderkey", "l_extendedprice", "l_quantity", F.inline(factors)).select(
        "model", F.when(F.col("l_orderkey") % 2 == 0, "Validation").otherwise("Test").alias("dataset"), "l_extendedprice", (F.col("l_quantity") * F.col("factor")).alias("p"),
    )
    # Models are compared without the median error, which would take most of the time.
    recorded = analysis.regression_metrics(scored, "l_extendedprice", "p", ["model", "dataset"], middle=False)
    compared = analysis.compare_models(recorded.withColumnsRenamed({"mae": "MAE", "rmse": "RMSE", "r2": "R2"}))
    return compared.select("model", "dataset", *[r4(F.col(m)).alias(m) for m in ("mae", "mse", "rmse", "r2")])


@query(
    "error_histogram",
    f"""WITH {SQL_GAPS}, e AS (SELECT min(error) AS lo, max(error) AS hi FROM gaps), b AS (SELECT i::BIGINT AS bin, lo + i * ((hi - lo) / 15) AS bin_start,
          CASE WHEN i = 14 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 15) END AS bin_end FROM e, generate_series(0, 14) AS s(i))
        SELECT bin, {sql_r4('bin_start')} AS bin_start, {sql_r4('bin_end')} AS bin_end, count(error) AS n_rows
        FROM b LEFT JOIN gaps ON error >= bin_start AND (error < bin_end OR bin = 14) GROUP BY bin, bin_start, bin_end""",
)
def error_histogram(t):
    bars = analysis.histogram(part_gaps(t), "error")
    return bars.select(long(F.col("bin")).alias("bin"), r4(F.col("bin_start")).alias("bin_start"), r4(F.col("bin_end")).alias("bin_end"), "n_rows")


@query("scatter_extent", f"WITH {SQL_GAPS} SELECT {sql_r4('greatest(max(actual), max(predicted))')} AS axis_max FROM gaps")
def scatter_extent(t):
    return analysis.scatter(part_gaps(t), "actual", "predicted")[1].select(r4(F.col("axis_max")).alias("axis_max"))


@query("scatter_points", f"WITH {SQL_GAPS} SELECT {sql_r4('actual')} AS actual, {sql_r4('predicted')} AS predicted FROM gaps")
def scatter_points(t):
    return analysis.scatter(part_gaps(t), "actual", "predicted")[0].select(r4(F.col("actual")).alias("actual"), r4(F.col("predicted")).alias("predicted"))


@query("search_like", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(lower(p_name), 'red|blue w')")
def search_like(t):
    return analysis.search(t("part"), "p_name", " RED|blue w ").select("p_partkey", "p_name")


@query("view_projection", 'SELECT p_name AS player, p_brand AS squad, p_retailprice AS "Market Value", p_retailprice * 2 AS "Predicted Price" FROM part')
def view_projection(t):
    table = t("part").withColumnsRenamed({"p_name": "player", "p_brand": "squad", "p_retailprice": "Market Value"})
    table = table.withColumn("predicted_market_value", F.col("`Market Value`") * 2)
    return analysis.view(table, ["player", "position", "squad", "Market Value", "predicted_market_value"], {"predicted_market_value": "Predicted Price"})


@query("partition_lookup", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'")
def partition_lookup(t):
    """Looked up in two partitioned tables; the first holds no such rows, and only one folder of the second is read."""
    orders, keys = t("orders"), ["o_orderstatus", "o_orderpriority"]
    paths = [fresh_path(t.spark) for _ in range(2)]
    for rows, path in zip((orders.filter("o_orderstatus <> 'F'"), orders), paths):
        writers.write_partitioned(rows, path, keys)
    tables = [readers.scan_parquet(t.spark, path) for path in paths]
    return analysis.lookup_first(tables, o_orderstatus="F", o_orderpriority="2-HIGH").select("o_orderkey", "o_custkey", "o_totalprice")


# ---- flagship ----------------------------------------------------------------------------------

SQL_FLAGSHIP = f"""d AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {SQL_LINE_ORDER}) = 1),
    c AS (SELECT l_partkey, year(l_shipdate) AS season, sum(l_extendedprice * l_quantity) / sum(l_quantity) AS price, sum(l_quantity) AS quantity,
            sum(l_linenumber * l_quantity) / sum(l_quantity) AS lines FROM d GROUP BY 1, 2),
    v AS (SELECT l_partkey, season, p_retailprice AS actual, price / nullif(quantity, 0) * lines AS predicted FROM c LEFT JOIN part ON p_partkey = l_partkey),
    g AS (SELECT *, predicted - actual AS error FROM v)"""


@query(
    "flagship_over_under",
    f"""WITH {SQL_FLAGSHIP}, o AS (SELECT 'over' AS side, * FROM g WHERE error > 0 ORDER BY error DESC, l_partkey, season LIMIT 5),
        u AS (SELECT 'under' AS side, * FROM g WHERE error < 0 ORDER BY error, l_partkey, season LIMIT 5)
        SELECT side, l_partkey, season, {sql_r4('actual')} AS actual, {sql_r4('predicted')} AS predicted, {sql_r4('error')} AS error
        FROM (SELECT * FROM o UNION ALL SELECT * FROM u)""",
)
def flagship_over_under(t):
    """Dedupe, collapse per part and season, derive a price, compare with the list price, five most over- and under-valued."""
    lines = clean.dedupe_first(t("lineitem").select(*LINE_ORDER), ["l_orderkey", "l_linenumber"], line_order())
    lines = lines.withColumn("season", long(F.year("l_shipdate")))
    rules = {"l_quantity": "sum", "l_extendedprice": "wmean", "l_linenumber": "wmean"}
    one = collapse.collapse(lines, ["l_partkey", "season"], "l_quantity", rules)
    predicted = numbers.safe_ratio(F.col("l_extendedprice"), F.col("l_quantity")) * F.col("l_linenumber")
    prices = t("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").alias("actual"))
    gaps = analysis.valuation_gap(one.withColumn("predicted", predicted).join(prices, "l_partkey", "left"), "actual", "predicted")
    top = analysis.gap_reports(gaps, 5, [F.col("l_partkey"), F.col("season")])
    sides = top["overvalued"].withColumn("side", F.lit("over")).unionByName(top["undervalued"].withColumn("side", F.lit("under")))
    return sides.select("side", "l_partkey", "season", *[r4(F.col(c)).alias(c) for c in ("actual", "predicted", "error")])
