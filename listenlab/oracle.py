"""Independent DuckDB statements of every registered query (the correctness oracle).

Each entry is plain SQL over the driver's pre-registered tables. The listens
view is repeated as a CTE so each statement stands alone. Column names and
types follow the Spark side: INTEGER for int columns and ranks, BIGINT for
counts, DOUBLE for measures.
"""

from __future__ import annotations

from .registry import ARTIST, BRANDS, MAP_LABEL, STATE
from .functions.text import PY_WHITESPACE
from .operators import summaries as S
from .sources.schema import US_STATES
from .sources.tables import (
    NATION_STATE_CODES,
    NULL_ARTIST_BRAND,
    NULL_USER_CUSTKEY,
    OUTSIDE_STATES_CODE,
    OUTSIDE_STATES_NATION,
    UNDATED_ORDERS,
)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_CODES = ",".join(f"({i},{_q(c)})" for i, c in NATION_STATE_CODES)
_STATES = ",".join(f"({i},{_q(n)},{_q(c)})" for i, (n, c) in enumerate(US_STATES, 1))

LISTENS = f"""
listens AS (
  SELECT
    nullif(o.o_custkey, {NULL_USER_CUSTKEY}) AS userId,
    c.c_name AS lastName,
    c.c_mktsegment AS firstName,
    CASE WHEN o.o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    p.p_name || ' ü' AS song,
    p.p_name || CASE o.o_orderkey % 3 WHEN 0 THEN ' ü' WHEN 1 THEN ' Ã¼' ELSE ' Ã' || chr(131) || 'Â¼' END AS raw_song,
    nullif(p.p_brand, {_q(NULL_ARTIST_BRAND)}) AS artist,
    l.l_quantity AS duration,
    o.o_orderkey AS sessionId,
    l.l_linenumber AS itemInSession,
    'Logged In' AS auth,
    CASE WHEN o.o_orderpriority = '1-URGENT' AND o.o_orderkey % 10 = 0 THEN 'paid' ELSE 'free' END AS subscription,
    n.n_name AS city,
    CASE WHEN c.c_nationkey = {OUTSIDE_STATES_NATION} THEN {_q(OUTSIDE_STATES_CODE)} ELSE d.code END AS state,
    lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS zip,
    CAST(c.c_nationkey AS DOUBLE) AS lat,
    CAST(-c.c_nationkey AS DOUBLE) AS lon,
    o.o_custkey AS registration,
    'fixture' AS userAgent,
    epoch_ms(o.at) AS ts_ms,
    o.at AS ts,
    CAST(year(o.at) AS INTEGER) AS year,
    CAST(month(o.at) AS INTEGER) AS month,
    strftime(o.at, '%B') AS month_name
  FROM lineitem l
  JOIN (SELECT *, CASE WHEN o_orderkey % {UNDATED_ORDERS} <> 0 THEN o_orderdate END AS at FROM orders) o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN (VALUES {_CODES}) AS d(idx, code) ON d.idx = c.c_nationkey
)"""

CLEAN_COLS = (
    "userId, lastName, firstName, gender, song, artist, duration, sessionId, itemInSession, auth, "
    "subscription, city, state, zip, lat, lon, registration, userAgent, ts, year, month, month_name"
)
RAW_COLS = (
    "userId, lastName, firstName, gender, raw_song AS song, artist, duration, sessionId, itemInSession, auth, "
    "subscription AS level, city, state, zip, lat, lon, registration, userAgent, ts_ms AS ts"
)

# Effective subscription: users with any paid listen (NULL user never flagged).
EFFECTIVE = """
paid AS (SELECT DISTINCT userId FROM listens WHERE subscription = 'paid' AND userId IS NOT NULL),
eff AS (
  SELECT l.*, l.subscription AS raw_subscription,
         CASE WHEN p.userId IS NOT NULL THEN 'paid' ELSE l.subscription END AS eff_subscription
  FROM listens l LEFT JOIN paid p ON l.userId = p.userId
)"""

MONTHLY_ALL = """
monthly AS (
  SELECT state AS location, year, month, month_name, eff_subscription AS subscription,
         sum(duration) / 60 AS total_duration
  FROM eff WHERE state IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT 'Nationwide' AS location, year, month, month_name, eff_subscription AS subscription,
         sum(duration) / 60 AS total_duration
  FROM eff GROUP BY ALL
)"""

# Totals in seconds (exact sums), divided by 60 once, as on the Spark side.
MONTHLY_STATS = """
mon_s AS (
  SELECT state AS location, year, month, month_name, eff_subscription AS subscription, sum(duration) AS seconds
  FROM eff WHERE state IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT 'Nationwide' AS location, year, month, month_name, eff_subscription AS subscription, sum(duration) AS seconds
  FROM eff GROUP BY ALL
),
bs AS (
  SELECT location, month_name, subscription, sum(coalesce(seconds, 0)) AS amount, count(*) AS n
  FROM mon_s GROUP BY ALL
),
bm AS (
  SELECT location, month_name, sum(amount) AS amount, sum(n) AS n,
         string_agg(subscription || ': ' || format('{:.0f}', amount / 60.0), ', ' ORDER BY subscription)
           FILTER (WHERE subscription IS NOT NULL) AS breakdown
  FROM bs GROUP BY ALL
),
st AS (
  SELECT location,
         CAST(sum(n) AS BIGINT) AS n_rows,
         sum(amount) / 60.0 AS total_minutes,
         avg(amount) FILTER (WHERE month_name IS NOT NULL) / 60.0 AS avg_month_minutes,
         arg_min(month_name, {'m': -amount, 'k': month_name}) FILTER (WHERE month_name IS NOT NULL) AS peak_month,
         max(amount) FILTER (WHERE month_name IS NOT NULL) / 60.0 AS peak_minutes,
         arg_min(month_name, {'m': amount, 'k': month_name}) FILTER (WHERE month_name IS NOT NULL) AS low_month,
         min(amount) FILTER (WHERE month_name IS NOT NULL) / 60.0 AS low_minutes,
         arg_min(breakdown, {'m': -amount, 'k': month_name}) FILTER (WHERE month_name IS NOT NULL) AS peak_breakdown
  FROM bm GROUP BY location
)"""

# Per-artist counts over the 51 states with dimension order; zero-filled.
STATE_GRID = f"""
us AS (SELECT * FROM (VALUES {_STATES}) AS s(position, NAME, state)),
ac AS (SELECT artist, state, count(*) AS listens FROM listens WHERE artist IS NOT NULL GROUP BY ALL),
arts AS (SELECT artist, sum(listens) AS nationwide_listens FROM ac GROUP BY artist),
grid AS (
  SELECT a.artist, u.state, CAST(coalesce(ac.listens, 0) AS BIGINT) AS listens, u.NAME, CAST(u.position AS INTEGER) AS position,
         a.nationwide_listens
  FROM arts a CROSS JOIN us u
  LEFT JOIN ac ON ac.artist = a.artist AND ac.state = u.state
),
mstats AS (
  SELECT artist,
         CAST(max(nationwide_listens) AS BIGINT) AS nationwide_listens,
         CAST(sum(listens) AS BIGINT) AS total_listens,
         sum(listens) / 51.0 AS avg_listens,
         arg_max(state, {{'l': listens, 'p': -position}}) AS top_state,
         max(listens) AS top_listens,
         arg_min(state, {{'l': listens, 'p': position}}) AS low_state,
         min(listens) AS low_listens
  FROM grid GROUP BY artist
)"""


def _rank(order: str, partition: str = "") -> str:
    part = f"PARTITION BY {partition} " if partition else ""
    return f"CAST(row_number() OVER ({part}ORDER BY {order}) AS INTEGER)"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _f0(x: str) -> str:
    return f"format('{{:.0f}}', CAST({x} AS DOUBLE))"


def _filled(template: str, *parts: str) -> str:
    """A fixed sentence with SQL expressions in its `{}` slots."""
    texts = template.split("{}")
    pieces = [_q(texts[0])]
    for part, text in zip(parts, texts[1:], strict=True):
        pieces += [part, _q(text)]
    return " || ".join(pieces)


def _monthly_prompt_sql() -> str:
    text = (
        f"{_q(S.SUMMARIZE)} || "
        f"{_filled(S.TOTAL_TIME, _f0('total_minutes'))} || {_filled(S.AVERAGE_MONTH, _f0('avg_month_minutes'))} || "
        f"{_filled(S.PEAK_MONTH, 'peak_month', _f0('peak_minutes'))} || "
        f"{_filled(S.LOW_MONTH, 'low_month', _f0('low_minutes'))} || {_filled(S.PEAK_BREAKDOWN, 'peak_breakdown')}"
    )
    return (
        _with(LISTENS, EFFECTIVE, MONTHLY_STATS)
        + f"SELECT location, n_rows, CASE WHEN n_rows = 0 THEN {_q(S.EMPTY_MONTHLY)} ELSE {text} END AS prompt FROM st"
    )


def _map_prompt_sql() -> str:
    lab = _q(MAP_LABEL)
    text = (
        f"{_q(S.SUMMARIZE)} || {_filled(S.MAP_TOTAL_NATION, _f0('total_listens'))} || "
        f"{_filled(S.MAP_TOTAL_IN, lab, _f0('total_listens'))} || {_filled(S.MAP_AVERAGE_IN, lab, _f0('avg_listens'))} || "
        f"{_filled(S.MAP_TOP, 'top_state', _f0('top_listens'))} || {_filled(S.MAP_LOW, 'low_state', _f0('low_listens'))}"
    )
    return _with(LISTENS, STATE_GRID) + f"SELECT artist, {lab} AS label, {text} AS prompt FROM mstats"


def _qa_sql() -> str:
    questions = ",".join(f"({_q(x)})" for x in S.DEFAULT_QUESTIONS)
    return _with(LISTENS) + f"""
, ac AS (SELECT artist, state, count(*) AS listens FROM listens WHERE artist IS NOT NULL GROUP BY ALL),
per AS (
  SELECT artist,
         arg_min(coalesce(state, 'None'), {{'a': -listens, 'b': state IS NULL, 'c': state}}) AS mx_state,
         arg_min(listens, {{'a': -listens, 'b': state IS NULL, 'c': state}}) AS mx_listens,
         arg_min(coalesce(state, 'None'), {{'a': listens, 'b': state IS NULL, 'c': state}}) AS mn_state,
         arg_min(listens, {{'a': listens, 'b': state IS NULL, 'c': state}}) AS mn_listens,
         sum(listens) AS total,
         string_agg({_filled(S.QA_STATE_SENTENCE, "coalesce(state, 'None')", 'artist', 'CAST(listens AS VARCHAR)')}, ' '
                    ORDER BY listens DESC, state ASC NULLS LAST) AS all_rows
  FROM ac GROUP BY artist
),
q AS (SELECT * FROM (VALUES {questions}) AS t(question)),
ctx AS (
  SELECT artist, question,
    CASE
      WHEN contains(lower(question), {_q(S.QA_MOST)}) THEN {_filled(S.QA_STATE_SENTENCE, 'mx_state', 'artist', 'CAST(mx_listens AS VARCHAR)')}
      WHEN contains(lower(question), {_q(S.QA_LEAST)}) THEN {_filled(S.QA_STATE_SENTENCE, 'mn_state', 'artist', 'CAST(mn_listens AS VARCHAR)')}
      WHEN contains(lower(question), {_q(S.QA_TOP)}) THEN {_filled(S.QA_TOP_SENTENCE, 'mx_state', 'artist', 'CAST(mx_listens AS VARCHAR)')}
      WHEN contains(lower(question), {_q(S.QA_BOTTOM)}) THEN {_filled(S.QA_BOTTOM_SENTENCE, 'mn_state', 'artist', 'CAST(mn_listens AS VARCHAR)')}
      WHEN contains(lower(question), {_q(S.QA_TOTAL)}) THEN {_filled(S.QA_TOTAL_SENTENCE, 'CAST(total AS VARCHAR)')}
      ELSE all_rows
    END AS context
  FROM per CROSS JOIN q
)
SELECT artist, question, context, 'Table: ' || context || chr(10) || 'Question: ' || question || chr(10) || 'Answer:' AS prompt FROM ctx"""


def _table_prompt_sql() -> str:
    line = (
        "'year=' || coalesce(CAST(year AS VARCHAR), 'None') || ', month=' || coalesce(CAST(month AS VARCHAR), 'None') || "
        "', month_name=' || coalesce(month_name, 'None') || ', subscription=' || coalesce(subscription, 'None') || "
        "', total_duration=' || coalesce(format('{:.2f}', total_duration), 'nan')"
    )
    return _with(LISTENS, EFFECTIVE, MONTHLY_ALL) + f"""
SELECT location, CAST(count(*) AS INTEGER) AS n_rows,
       {_q(S.TABLE_PROMPT_HEAD)} || string_agg({line}, chr(10) ORDER BY year NULLS FIRST, month NULLS FIRST, subscription NULLS FIRST) || {_q(S.TABLE_PROMPT_TAIL)} AS prompt
FROM monthly GROUP BY location"""


def _capitalize_sql() -> str:
    ws = PY_WHITESPACE
    word = (
        "CASE WHEN NOT regexp_matches(w, '[\\p{Lu}\\p{Lt}]') AND regexp_matches(w, '\\p{Ll}') "
        "THEN (CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END) || w[2:] ELSE w END"
    )
    return (
        "SELECT doc_id, array_to_string(list_transform(string_split(text, '. '), "
        f"lambda s: array_to_string(list_transform(list_filter(regexp_split_to_array(s, {_q(ws)}), lambda w: w <> ''), "
        f"lambda w: {word}), ' ')), '. ') AS text FROM documents"
    )


def _misread_sql(text: str) -> str:
    """The UTF-8 bytes of `text`, each as the character of its number."""
    at = {k: f"chr(CAST(128 + (ord(t) // {64**k}) % 64 AS INTEGER))" for k in range(3)}
    first = lambda base, k: f"chr(CAST({base} + ord(t) // {64**k} AS INTEGER))"
    return (
        f"array_to_string(list_transform(regexp_extract_all({text}, '[\\x00-\\x7F]+|[^\\x00-\\x7F]'), lambda t: CASE "
        f"WHEN ord(t) < 128 THEN t WHEN ord(t) < 2048 THEN {first(192, 1)} || {at[0]} "
        f"WHEN ord(t) < 65536 THEN {first(224, 2)} || {at[1]} || {at[0]} ELSE {first(240, 3)} || {at[2]} || {at[1]} || {at[0]} END), '')"
    )


def _decode_sql(text: str) -> str:
    """The characters of `text` taken as bytes and decoded as UTF-8; a longest part of a sequence that isn't valid becomes U+FFFD."""
    tail, r = "[\\x{80}-\\x{BF}]", lambda a, b: f"[\\x{{{a}}}-\\x{{{b}}}]"
    pattern = "|".join([
        "[\\x00-\\x7F]+", r("C2", "DF") + tail,
        f"\\x{{E0}}{r('A0', 'BF')}{tail}?", f"(?:{r('E1', 'EC')}|{r('EE', 'EF')}){tail}{{1,2}}", f"\\x{{ED}}{r('80', '9F')}{tail}?",
        f"\\x{{F0}}{r('90', 'BF')}{tail}{{0,2}}", f"{r('F1', 'F3')}{tail}{{1,3}}", f"\\x{{F4}}{r('80', '8F')}{tail}{{0,2}}", r("80", "FF"),
    ])
    bits = lambda n: " + ".join([f"(ord(t[1]) - {[0, 0, 192, 224, 240][n]}) * {64 ** (n - 1)}", *(f"(ord(t[{k}]) - 128) * {64 ** (n - k)}" for k in range(2, n + 1))])
    whole = " ".join(f"WHEN length(t) = {n} AND ord(t[1]) BETWEEN {a} AND {b} THEN chr(CAST({bits(n)} AS INTEGER))" for n, a, b in ((2, 194, 223), (3, 224, 239), (4, 240, 244)))
    return f"array_to_string(list_transform(regexp_extract_all({text}, '{pattern}'), lambda t: CASE WHEN ord(t) < 128 THEN t {whole} ELSE chr(65533) END), '')"


def _repair_compat_sql() -> str:
    """Texts read wrongly 0, 1 or 2 times. Undoing one layer gives the text; the rules then take a second step, which damages what isn't UTF-8."""
    once = (
        f"CASE WHEN regexp_matches(text, '^[\\x00-\\x7F]*$') THEN text WHEN contains(text, '?') OR regexp_matches(text, '[^\\x{{00}}-\\x{{FF}}]') THEN misread "
        "WHEN decoded <> text AND NOT contains(decoded, '?') THEN decoded ELSE text END"
    )
    twice = "CASE WHEN contains(text, '?') THEN misread_twice ELSE text END"
    return f"""
WITH one AS (SELECT doc_id, text, {_misread_sql('text')} AS misread FROM documents),
two AS (SELECT *, {_misread_sql('misread')} AS misread_twice,
               CASE WHEN NOT regexp_matches(text, '[^\\x{{00}}-\\x{{FF}}]') THEN {_decode_sql('text')} END AS decoded FROM one)
SELECT doc_id, CAST(0 AS INTEGER) AS layers, text FROM documents
UNION ALL SELECT doc_id, CAST(1 AS INTEGER), {once} FROM two
UNION ALL SELECT doc_id, CAST(2 AS INTEGER), {twice} FROM two"""


def oracle_sql() -> dict[str, str]:
    L = _with(LISTENS)
    counts_as = "ac AS (SELECT artist, state, count(*) AS listens FROM listens GROUP BY ALL)"
    def top_art(sel: str, part: str, src: str) -> str:
        return (
            f"SELECT {sel}artist AS Artist, cnt AS \"Total Streams\", rnk AS rank FROM ("
            f"SELECT {sel}artist, cnt, {_rank('cnt DESC, artist ASC NULLS LAST', part)} AS rnk FROM ({src})) "
            "WHERE rnk <= 10"
        )

    def loc_counts(keys: str) -> str:
        return (
            f"SELECT state AS location, {keys}, count(*) AS cnt FROM listens WHERE state IS NOT NULL GROUP BY ALL "
            f"UNION ALL SELECT 'Nationwide' AS location, {keys}, count(*) AS cnt FROM listens GROUP BY ALL"
        )

    mix_sel = (
        "subscription, cnt AS count, CAST(cnt AS DOUBLE) / sum(cnt) OVER ({p}) * 100.0 AS percentage, "
        "format('{{:.1f}}', CAST(cnt AS DOUBLE) / sum(cnt) OVER ({p}) * 100.0) || '%' AS percentage_text"
    )

    def songs(keys: str, part: str, src: str) -> str:
        return (
            f"SELECT {keys}, cnt AS listens, rnk AS rank FROM ("
            f"SELECT {keys}, cnt, {_rank('cnt DESC, song ASC NULLS LAST', part)} AS rnk FROM ({src})) WHERE rnk <= 5"
        )

    def docs(layers: tuple[int, ...]) -> str:
        return " UNION ALL ".join(
            f"SELECT doc_id, CAST({n} AS INTEGER) AS layers, text FROM documents" for n in layers
        )

    bottom = (
        "SELECT artist AS Artist, cnt AS \"Total Streams\", rnk AS rank FROM ("
        "SELECT artist, cnt, " + _rank("cnt ASC, artist ASC NULLS LAST") + " AS rnk FROM "
        "(SELECT artist, count(*) AS cnt FROM listens GROUP BY artist)) WHERE rnk <= 3"
    )
    kpi = (
        "SELECT CAST(count(DISTINCT userId) + coalesce(max(CASE WHEN userId IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS total_users, "
        "avg(duration) AS avg_duration, sum(CASE WHEN subscription = 'paid' THEN duration END) AS paid_duration FROM {src}"
    )
    return {
        "read_listens": L + f"SELECT {RAW_COLS} FROM listens",
        "clean_listens": L + f"SELECT {CLEAN_COLS} FROM listens",
        "read_clean": L + f"SELECT {CLEAN_COLS} FROM listens",
        "repair_text_compat": _repair_compat_sql(),
        "repair_text_strict": docs((0, 1, 2)),
        "capitalize_sentences": _capitalize_sql(),
        "coerce_numeric": (
            "SELECT event_id, raw, TRY_CAST(raw AS DOUBLE) AS value FROM ("
            "SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(event_id AS VARCHAR) END AS raw FROM events)"
        ),
        "artist_state_listens": L + (
            f"SELECT artist, state, count(*) AS listens, {_rank('count(*) DESC, state ASC NULLS LAST')} AS rank "
            f"FROM listens WHERE artist = {_q(ARTIST)} GROUP BY artist, state"
        ),
        "artist_state_listens_all": L + "SELECT artist, state, count(*) AS listens FROM listens GROUP BY ALL",
        "artists_over": L + (
            f"SELECT artist, count(*) AS listens, {_rank('count(*) DESC, artist ASC NULLS LAST')} AS rank "
            f"FROM listens GROUP BY artist HAVING count(*) >= (SELECT count(*) // {BRANDS} FROM lineitem)"
        ),
        "top_n_by_listens": _with(LISTENS, counts_as) + (
            "SELECT artist, state, listens, rnk AS rank FROM (SELECT *, "
            + _rank("listens DESC, artist ASC NULLS LAST, state ASC NULLS LAST")
            + " AS rnk FROM ac) WHERE rnk <= 5"
        ),
        "states_list": L + (
            f"SELECT state, {_rank('state ASC NULLS LAST')} AS rank FROM (SELECT DISTINCT state FROM listens)"
        ),
        "top_artists": L + top_art("", "", "SELECT artist, count(*) AS cnt FROM listens GROUP BY artist"),
        "top_artists_all": L + top_art("location, ", "location", loc_counts("artist")),
        "bottom_artists": L + bottom,
        "top_songs_free": L + songs(
            keys="state, song", part="",
            src=f"SELECT state, song, count(*) AS cnt FROM listens WHERE subscription = 'free' AND state = {_q(STATE)} GROUP BY ALL",
        ),
        "top_songs_paid": L + songs(
            keys="song", part="", src="SELECT song, count(*) AS cnt FROM listens WHERE subscription = 'paid' GROUP BY song"
        ),
        "top_songs_all": L + songs(
            keys="location, subscription, song", part="location, subscription",
            src="SELECT * FROM (" + loc_counts("subscription, song") + ") WHERE subscription IN ('free', 'paid')",
        ),
        "kpis": L + kpi.format(src="listens"),
        "kpi_cards": L + (
            "SELECT total_users, avg_duration, paid_duration, "
            "format('{:.0f}', CAST(total_users AS DOUBLE) / 1000.0) || 'k+' AS users_card, "
            "format('{:.0f}', avg_duration / 60.0) || ' MIN' AS listening_card, "
            "format('{:.0f}', paid_duration / 3600000.0) || 'k+ H' AS paid_card FROM ("
            + kpi.format(src="listens")
            + ")"
        ),
        "subscription_mix": L + (
            f"SELECT {mix_sel.format(p='')}, {_rank('cnt DESC, subscription ASC NULLS LAST')} AS rank FROM (SELECT subscription, count(*) AS cnt FROM listens "
            f"WHERE state = {_q(STATE)} GROUP BY subscription)"
        ),
        "subscription_mix_all": L + (
            f"SELECT location, {mix_sel.format(p='PARTITION BY location')} FROM ({loc_counts('subscription')})"
        ),
        "effective_subscription": _with(LISTENS, EFFECTIVE) + (
            "SELECT userId, sessionId, itemInSession, state, raw_subscription, eff_subscription AS subscription FROM eff"
        ),
        "monthly_listening": _with(LISTENS, EFFECTIVE) + (
            "SELECT year, month, month_name, eff_subscription AS subscription, sum(duration) / 60 AS total_duration, "
            f"{_rank('year NULLS FIRST, month NULLS FIRST, eff_subscription NULLS FIRST')} AS rank "
            f"FROM eff WHERE state = {_q(STATE)} GROUP BY year, month, month_name, eff_subscription"
        ),
        "monthly_listening_all": _with(LISTENS, EFFECTIVE, MONTHLY_ALL) + "SELECT * FROM monthly",
        "monthly_stats": _with(LISTENS, EFFECTIVE, MONTHLY_STATS) + (
            "SELECT location, n_rows, total_minutes, avg_month_minutes, "
            "peak_month, peak_minutes, low_month, low_minutes, peak_breakdown FROM st"
        ),
        "state_map": _with(LISTENS, STATE_GRID.replace("WHERE artist IS NOT NULL", f"WHERE artist = {_q(ARTIST)}")) + (
            f"SELECT {_q(ARTIST)} AS artist, u.state, CAST(coalesce(ac.listens, 0) AS BIGINT) AS listens, u.NAME, "
            "CAST(u.position AS INTEGER) AS position FROM us u LEFT JOIN ac ON ac.state = u.state"
        ),
        "state_map_all": _with(LISTENS, STATE_GRID) + "SELECT artist, state, listens, NAME, position FROM grid",
        "map_stats": _with(LISTENS, STATE_GRID) + "SELECT * FROM mstats",
        "monthly_summary_prompt": _monthly_prompt_sql(),
        "map_summary_prompt": _map_prompt_sql(),
        "bottom_artists_prompt": L + (
            "SELECT CAST(count(*) AS INTEGER) AS n_artists, "
            f"string_agg(coalesce(Artist, {_q(S.UNKNOWN_ARTIST)}), ', ' ORDER BY rank) AS artists, "
            "string_agg(CAST(\"Total Streams\" AS VARCHAR), ', ' ORDER BY rank) AS listens, "
            f"CASE WHEN count(*) = 0 THEN {_q(S.EMPTY_BOTTOM)} ELSE {_q(S.SUMMARIZE_CONCISELY)} || "
            + _filled(
                S.BOTTOM_ARTISTS,
                f"string_agg(coalesce(Artist, {_q(S.UNKNOWN_ARTIST)}), ', ' ORDER BY rank)",
                "string_agg(CAST(\"Total Streams\" AS VARCHAR), ', ' ORDER BY rank)",
            )
            + " END AS prompt "
            f"FROM ({bottom})"
        ),
        "qa_context": _qa_sql(),
        "table_prompt": _table_prompt_sql(),
    }
