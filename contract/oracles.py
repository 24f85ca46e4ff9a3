"""The same results as SQL for DuckDB, written from the rules and not from the plans."""

from __future__ import annotations

from collections.abc import Sequence

from cairn.vocab import GEAR_CATEGORIES, HOT_SUBMISSIONS, WEATHER_SEASON_WORDS, WEATHER_VARIABLES
from contract import standins as S

ORACLES: dict[str, str] = {}

# Ways, peaks and their points, as the stand-ins define them.
_ELEMENTS = """
els AS (
  SELECT o_orderkey AS ord, CASE WHEN o_orderstatus = 'P' THEN 'node' ELSE 'way' END AS type,
         CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE o_custkey::VARCHAR END AS name,
         o_orderstatus = 'O' AS open, o_orderpriority AS surface,
         o_orderkey % 5 IN (0, 1, 4) AS footpath, o_orderkey % 3 <> 0 AS peak,
         CASE WHEN o_orderkey % 4 = 0 THEN 'hiking' END AS sac_scale,
         CASE WHEN o_orderkey % 7 = 0 THEN 'good' END AS trail_visibility,
         month(o_orderdate) AS n, day(o_orderdate)::DOUBLE AS d, (o_custkey // 4)::DOUBLE AS base
  FROM orders),
pts AS (
  SELECT ord, i, d + (i::DOUBLE - (n + 1)::DOUBLE / 2) * 0.75::DOUBLE AS lon, base + i % 2 AS lat
  FROM els, unnest(range(1, n + 1)) AS u(i) WHERE type = 'way'),
lines AS (
  SELECT ord, 'LINESTRING (' || string_agg(lon_text || ' ' || lat_text, ', ' ORDER BY i) || ')' AS wkt
  FROM (SELECT ord, i, rtrim(rtrim(printf('%.6f', lon), '0'), '.') AS lon_text,
               rtrim(rtrim(printf('%.6f', lat), '0'), '.') AS lat_text FROM pts)
  GROUP BY ord),
mids AS (
  SELECT ord, sqrt((lon - plon) ** 2 + (lat - plat) ** 2) AS len,
         (lon + plon) / 2 AS mx, (lat + plat) / 2 AS my
  FROM (SELECT *, lag(lon) OVER w AS plon, lag(lat) OVER w AS plat FROM pts
        WINDOW w AS (PARTITION BY ord ORDER BY i))
  WHERE plon IS NOT NULL),
cents AS (
  SELECT ord, sum(len * mx) / sum(len) AS lon, sum(len * my) / sum(len) AS lat
  FROM mids GROUP BY ord),
segs AS (
  SELECT *, min(ord) OVER (PARTITION BY name) AS first_ord,
         row_number() OVER (PARTITION BY name ORDER BY n DESC, ord) AS place
  FROM els WHERE type = 'way' AND open AND name <> '')
"""



def _inside(area: tuple[float, float, float, float]) -> str:
    """Clips each stretch between neighbouring points to the area, as a range of its length."""
    south, west, north, east = area

    def enter(a: str, b: str, low: float, high: float, first: str, other: str) -> str:
        bounds = f"{first}(({low} - {a}) / ({b} - {a}), ({high} - {a}) / ({b} - {a}))"
        return f"CASE WHEN {a} <> {b} THEN {bounds} WHEN {a} BETWEEN {low} AND {high} THEN {other} END"

    return f"""
stretches AS (
  SELECT ord, lon, lat, lead(lon) OVER w AS lon2, lead(lat) OVER w AS lat2 FROM pts
  WINDOW w AS (PARTITION BY ord ORDER BY i)),
clipped AS (
  SELECT ord, {enter("lon", "lon2", west, east, "least", "0")} AS x0,
         {enter("lon", "lon2", west, east, "greatest", "1")} AS x1,
         {enter("lat", "lat2", south, north, "least", "0")} AS y0,
         {enter("lat", "lat2", south, north, "greatest", "1")} AS y1
  FROM stretches WHERE lon2 IS NOT NULL),
inside AS (
  SELECT ord FROM (
    SELECT ord FROM pts WHERE lat BETWEEN {south} AND {north} AND lon BETWEEN {west} AND {east}
    UNION
    SELECT ord FROM clipped WHERE x0 IS NOT NULL AND y0 IS NOT NULL
      AND greatest(x0, y0, 0) <= least(x1, y1, 1))
  JOIN els USING (ord) WHERE footpath
  UNION
  SELECT ord FROM els WHERE type = 'node' AND peak
    AND base BETWEEN {south} AND {north} AND d BETWEEN {west} AND {east})
"""


_INSIDE = _inside(S.AREA)


def _winners(where: str) -> str:
    return f"""
located AS (
  SELECT * FROM (
    SELECT segs.*, lat, lon, wkt,
           row_number() OVER (PARTITION BY lat, lon ORDER BY first_ord DESC, segs.ord DESC) AS last
    FROM segs JOIN cents USING (ord) JOIN lines USING (ord) WHERE {where})
  WHERE last = 1)
"""


def _weather_columns() -> str:
    out = []
    for i, v in enumerate(WEATHER_VARIABLES):
        if v in ("sunrise", "sunset"):
            out.append(f"event_id * 1000 + {i} AS {v}")
        elif v == "uv_index_max":
            out.append(f"CASE WHEN event_type <> 'error' THEN value + {i} END AS {v}")
        else:
            out.append(f"value + {i} AS {v}")
    return ", ".join(out)


_WEATHER = f"""
reports AS (
  SELECT event_id, user_id + 0.5::DOUBLE AS lat, day(ts)::DOUBLE AS lon, '{S.DAY}' AS weather_date,
         {_weather_columns()},
         row_number() OVER (PARTITION BY user_id, day(ts) ORDER BY ts DESC, event_id DESC) AS last
  FROM events WHERE event_type <> 'signup')
"""

ORACLES["area_selection"] = f"""
WITH {_ELEMENTS}, {_INSIDE} SELECT ord AS id, type FROM els JOIN inside USING (ord)
"""
ORACLES["way_selection"] = f"""
WITH {_ELEMENTS}, {_INSIDE}
SELECT ord AS id, name, surface, trail_visibility, sac_scale FROM segs JOIN inside USING (ord)
"""
ORACLES["area_crossing"] = f"""
WITH {_ELEMENTS}, {_inside(S.STRIP)} SELECT ord AS id, type FROM els JOIN inside USING (ord)
"""
ORACLES["segment_metrics"] = f"""
WITH {_ELEMENTS}, {_winners("true")}
SELECT count(*) AS segments, count(DISTINCT name) AS unique_names,
       count(*) FILTER (n < 2) AS too_short,
       count(DISTINCT CASE WHEN n >= 2 THEN name END) AS coordinates,
       (count(DISTINCT CASE WHEN n >= 2 THEN name END) + 9) // 10 AS batches
FROM segs
"""
ORACLES["segment_metrics_all"] = f"""
WITH {_ELEMENTS}, {_winners("true")}
SELECT count(*) AS segments, count(DISTINCT name) AS unique_names,
       count(*) FILTER (n < 2) AS too_short, count(*) FILTER (n >= 2) AS coordinates,
       (count(*) FILTER (n >= 2) + 9) // 10 AS batches
FROM segs
"""
ORACLES["longest_segments"] = f"""
WITH {_ELEMENTS} SELECT name, first_ord, ord, n AS n_points, surface FROM segs WHERE place = 1
"""
ORACLES["all_segments_order"] = f"WITH {_ELEMENTS} SELECT name, first_ord, ord FROM segs"
ORACLES["centroid_last_wins"] = f"""
WITH {_ELEMENTS}, {_winners("place = 1")}
SELECT lat, lon, name, surface, n AS n_points FROM located
"""
ORACLES["centroid_last_wins_all"] = f"""
WITH {_ELEMENTS}, {_winners("true")}
SELECT lat, lon, name, surface, n AS n_points FROM located
"""

_VECTOR_POINTS = """
pts AS (
  SELECT vec_id, i, embedding[2 * i + 1]::DOUBLE AS lon, embedding[2 * i + 2]::DOUBLE AS lat
  FROM embeddings, unnest(range(0, len(embedding) // 2)) AS u(i))
"""
ORACLES["line_centroids"] = f"""
WITH {_VECTOR_POINTS},
mids AS (
  SELECT vec_id, sqrt((lon - plon) ** 2 + (lat - plat) ** 2) AS len,
         (lon + plon) / 2 AS mx, (lat + plat) / 2 AS my
  FROM (SELECT *, lag(lon) OVER w AS plon, lag(lat) OVER w AS plat FROM pts
        WINDOW w AS (PARTITION BY vec_id ORDER BY i))
  WHERE plon IS NOT NULL)
SELECT vec_id, round(sum(len * my) / sum(len), 6) AS lat, round(sum(len * mx) / sum(len), 6) AS lon,
       any_value(h.lat) AS head_lat, any_value(h.lon) AS head_lon
FROM mids JOIN (SELECT vec_id, lat, lon FROM pts WHERE i = 0) AS h USING (vec_id) GROUP BY vec_id
"""
ORACLES["wkt_export"] = f"""
WITH {_VECTOR_POINTS}
SELECT vec_id, 'LINESTRING (' || string_agg(
  rtrim(rtrim(printf('%.6f', lon), '0'), '.') || ' ' || rtrim(rtrim(printf('%.6f', lat), '0'), '.'),
  ', ' ORDER BY i) || ')' AS wkt
FROM pts GROUP BY vec_id
"""
ORACLES["first_day_values"] = f"""
WITH {_WEATHER}
SELECT event_id, lat, lon, temperature_2m_max, sunset, uv_index_max, weather_date FROM reports
"""
ORACLES["weather_last_wins"] = f"""
WITH {_WEATHER} SELECT lat, lon, {", ".join(WEATHER_VARIABLES)} FROM reports WHERE last = 1
"""
ORACLES["trail_weather_join"] = f"""
WITH {_WEATHER}
SELECT c_name AS name, '{S.DAY}' AS weather_date, rain_sum, sunrise
FROM customer LEFT JOIN (SELECT * FROM reports WHERE last = 1 AND lon = 1) AS r
  ON r.lat = c_custkey + 0.5::DOUBLE
"""
ORACLES["request_batch_ids"] = """
SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) // 10 AS batch_id,
       (row_number() OVER (ORDER BY c_custkey) - 1) % 10 AS batch_pos FROM customer
"""
ORACLES["request_batch_ids_events"] = """
SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 64 AS batch_id,
       (row_number() OVER (ORDER BY event_id) - 1) % 64 AS batch_pos FROM events
"""


def _trail_batches(where: str) -> str:
    return f"""
WITH {_ELEMENTS}
SELECT ord, (row_number() OVER (ORDER BY first_ord, ord) - 1) // 10 AS batch_id,
       (row_number() OVER (ORDER BY first_ord, ord) - 1) % 10 AS batch_pos
FROM segs WHERE {where}
"""


ORACLES["trail_request_batches"] = _trail_batches("place = 1")
ORACLES["trail_request_batches_all"] = _trail_batches("true")
ORACLES["batched_enrichment"] = """
SELECT c_acctbal AS lat, c_custkey::DOUBLE AS lon, c_acctbal * 2 AS doubled, c_custkey AS key
FROM customer WHERE c_acctbal >= 0
"""
ORACLES["epoch_to_timestamp"] = """
SELECT event_id, CASE WHEN event_type NOT IN ('error', 'purchase')
  THEN strftime(make_timestamp(event_id * 86399 * 1000000), '%Y-%m-%d %H:%M:%S') END AS at
FROM events
"""
ORACLES["coerce_date"] = """
SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d') END AS day FROM events
"""


def _sink_columns(alias: str) -> str:
    return ", ".join(
        f"strftime(make_timestamp({alias}.{v} * 1000000), '%Y-%m-%d %H:%M:%S') AS {v}"
        if v in ("sunrise", "sunset") else f"{alias}.{v}"
        for v in WEATHER_VARIABLES
    )


def _trail_weather(where: str) -> str:
    return f"""
WITH {_ELEMENTS}, {_winners(where)}, {_WEATHER}
SELECT name, surface, trail_visibility, sac_scale, '{S.DAY}' AS weather_date, {_sink_columns("r")}, wkt AS geometry
FROM located AS l LEFT JOIN (SELECT * FROM reports WHERE last = 1) AS r
  ON l.lat = r.lat AND l.lon = r.lon
"""


ORACLES["trail_weather"] = _trail_weather("place = 1")
ORACLES["trail_weather_all_segments"] = _trail_weather("true")
ORACLES["trails_without_weather"] = f"""
WITH {_ELEMENTS.replace("segs AS", "every AS")}, {_INSIDE},
segs AS (
  SELECT * EXCLUDE (first_ord, place), min(ord) OVER (PARTITION BY name) AS first_ord,
         row_number() OVER (PARTITION BY name ORDER BY n DESC, ord) AS place
  FROM every SEMI JOIN inside USING (ord)),
{_winners("place = 1")}
SELECT name, surface, trail_visibility, sac_scale, NULL::VARCHAR AS weather_date,
       {", ".join(f"NULL AS {v}" for v in WEATHER_VARIABLES)}, wkt AS geometry
FROM located
"""
ORACLES["osm_payload_scan"] = f"""
WITH {_ELEMENTS}
SELECT ord AS payload, pos, CASE pos WHEN 0 THEN ord ELSE -ord END AS id,
       CASE pos WHEN 0 THEN type ELSE 'node' END AS type,
       CASE WHEN pos = 1 THEN 1.5::DOUBLE WHEN type = 'node' THEN base END AS lat,
       CASE pos WHEN 0 THEN surface END AS surface, wkt
FROM els LEFT JOIN lines USING (ord), unnest([0, 1]) AS u(pos)
"""

# ------------------------------------------------------------------ text

# RE2 knows ASCII word boundaries only: other letters become an 'x' of the same length.
_SHADOW = r"regexp_replace({0}, '[^\x00-\x7F\p{{P}}\p{{Z}}\p{{S}}]', 'x', 'g')"
_CLEAN = (
    r"trim(regexp_replace(translate(coalesce({0}, ''), '’–—', '''--'),"
    r" '[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+', ' ', 'g'))"
)
_TOKEN = "[A-Za-z0-9]+(?:[-''][A-Za-z0-9]+)*"


def _any_word(text: str, words: Sequence[str]) -> str:
    shadow = _SHADOW.format(f"lower({text})")
    return rf"regexp_matches({shadow}, '\b(?:{'|'.join(words)})\b')"


def _first_word(text: str, words: Sequence[str]) -> str:
    shadow = _SHADOW.format(f"lower({text})")
    whens = " ".join(rf"WHEN regexp_matches(s, '\b{w}\b') THEN '{w}'" for w in words)
    return f"(SELECT CASE {whens} END FROM (SELECT {shadow} AS s))"


def _brand_regex() -> str:
    names = sorted({b.lower() for b in S.BRANDS}, key=len, reverse=True)
    initials = ["".join(p[0] for p in b.split()) for b in names if " " in b]
    return r"(?i)\b(?:" + "|".join(n.replace(" ", r"\s+") for n in names + initials) + r")\b"


def _mentions(source: str, keys: str, window: int) -> str:
    """Cuts the text at the mentions' places, then counts words on both sides."""
    left = f"lt[greatest(len(lt) - {window} + 1, 1):]" if window else "lt"
    right = f"rt[:{window}]" if window else "[]::VARCHAR[]"
    return rf"""
cleaned AS (SELECT {keys}, {_CLEAN.format("text")} AS t FROM ({source})),
shadowed AS (SELECT *, {_SHADOW.format("t")} AS s FROM cleaned),
cut AS (
  SELECT *, regexp_extract_all(s, '{_brand_regex()}') AS ms,
         list_transform(string_split_regex(s, '{_brand_regex()}'), lambda g: len(g)) AS gaps
  FROM shadowed),
placed AS (
  SELECT {keys}, t, p AS mention_pos, len(ms[p + 1]) AS size,
         coalesce(list_sum(gaps[:p + 1]), 0)
           + coalesce(list_sum(list_transform(ms[:p], lambda m: len(m))), 0) AS start
  FROM cut, unnest(range(0, len(ms))) AS u(p)),
sided AS (
  SELECT {keys}, mention_pos, substr(t, start::BIGINT + 1, size) AS mention,
         regexp_extract_all(substr(t, 1, start::BIGINT), '{_TOKEN}') AS lt,
         regexp_extract_all(substr(t, start::BIGINT + size + 1), '{_TOKEN}') AS rt
  FROM placed),
found AS (
  SELECT {keys}, mention_pos, lower(mention) AS gear_brand,
         array_to_string(list_concat(list_concat({left}, [mention]), {right}), ' ') AS brand_context
  FROM sided)
"""


ORACLES["top_submissions_per_community"] = f"""
SELECT doc_id AS submission_id, source AS subreddit FROM documents
WHERE source IN ({", ".join(f"'{s}'" for s in S.SOURCES)})
QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 20
"""
ORACLES["title_gate_documents"] = (
    f"SELECT doc_id FROM documents WHERE {_any_word('text', S.WEATHER_WORDS)}"
)
ORACLES["body_gate_documents"] = f"""
SELECT doc_id FROM documents
WHERE {_any_word("text", S.WEATHER_WORDS)} AND {_any_word("text", S.GEAR_WORDS)}
"""
ORACLES["keyword_tags"] = f"""
SELECT doc_id, {_first_word("text", WEATHER_SEASON_WORDS)} AS season,
       {_first_word("text", GEAR_CATEGORIES)} AS category,
       {_first_word("text", S.WEATHER_WORDS)} AS word,
       {_first_word("text", S.GEAR_WORDS)} AS thing
FROM documents
"""
ORACLES["normalized_text"] = f"SELECT doc_id, {_CLEAN.format('text')} AS clean FROM documents"
ORACLES["brand_mentions_documents"] = f"""
WITH {_mentions("SELECT doc_id, text FROM documents", "doc_id", 1)}
SELECT doc_id, mention_pos, gear_brand FROM found
"""
ORACLES["brand_context"] = f"""
WITH {_mentions("SELECT conv_id, turn, text FROM conversations", "conv_id, turn", 12)}
SELECT * FROM found
"""
ORACLES["brand_context_documents"] = f"""
WITH {_mentions("SELECT doc_id, text FROM documents", "doc_id", 3)} SELECT * FROM found
"""
ORACLES["brand_context_left_only"] = f"""
WITH {_mentions("SELECT conv_id, turn, text FROM conversations", "conv_id, turn", 0)}
SELECT * FROM found
"""
ORACLES["comment_submission_join"] = f"""
SELECT c.conv_id || '-' || c.turn AS comment_id, s.role AS subreddit, 'c/' || s.conv_id AS url
FROM conversations AS c JOIN conversations AS s ON s.conv_id = c.conv_id AND s.turn = 0
WHERE c.turn > 0 AND {_any_word("s.text", S.WEATHER_WORDS)}
"""
ORACLES["comment_flatten"] = """
WITH lines AS (
  SELECT doc_id, i, string_split(text, chr(10))[i + 1] AS line
  FROM documents, unnest(range(0, len(string_split(text, chr(10))))) AS u(i)),
sentences AS (
  SELECT doc_id, i, j, string_split(line, '. ')[j + 1] AS sentence
  FROM lines, unnest(range(0, len(string_split(line, '. ')))) AS u(j))
SELECT doc_id::VARCHAR AS submission_id, doc_id || '-' || i AS comment_id, line AS body FROM lines
UNION ALL
SELECT doc_id::VARCHAR, doc_id || '-' || i || '-' || j, sentence FROM sentences
WHERE length(sentence) >= 5
"""

_SCORES = """
raw AS (SELECT event_id, value AS a, 10.0::DOUBLE AS b, (event_id % 50)::DOUBLE AS c FROM events),
scored AS (
  SELECT event_id, a / (a + b + c) AS n, b / (a + b + c) AS u, c / (a + b + c) AS p FROM raw),
ranked AS (
  SELECT *, greatest(n, u, p) AS s, CASE WHEN n >= u AND n >= p THEN 'negative'
    WHEN u >= p THEN 'neutral' ELSE 'positive' END AS top
  FROM scored)
"""
for _name, _label, _score in [
    ("threshold", "CASE WHEN s < 0.5 THEN 'NEUTRAL' ELSE top END", "s"),
    ("weighted", "CASE WHEN s > 0.2 THEN top ELSE 'NEUTRAL' END", "s"),
    (
        "positive_bias",
        "CASE WHEN p > u * 0.6::DOUBLE THEN 'positive' WHEN n > u * 1.5 THEN 'negative' ELSE 'neutral' END",
        "CASE WHEN p > u * 0.6::DOUBLE THEN p WHEN n > u * 1.5 THEN n ELSE u END",
    ),
    ("raw", "top", "s"),
]:
    ORACLES[f"sentiment_{_name}"] = f"""
WITH {_SCORES} SELECT event_id, {_label} AS sent_label, round({_score}, 6) AS sent_score FROM ranked
"""


def _count(text: str, words: Sequence[str]) -> str:
    shadow = _SHADOW.format(f"lower({text})")
    return rf"len(regexp_extract_all({shadow}, '\b(?:{'|'.join(words)})\b'))"


ORACLES["lexicon_scores"] = f"""
WITH counted AS (
  SELECT doc_id, {_count("text", S.POSITIVE)} AS p, {_count("text", S.NEGATIVE)} AS n FROM documents)
SELECT doc_id, round(n / (p + n + 1)::DOUBLE, 6) AS negative,
       round(1 / (p + n + 1)::DOUBLE, 6) AS neutral, round(p / (p + n + 1)::DOUBLE, 6) AS positive
FROM counted
"""

ORACLES["model_scores"] = """
WITH counted AS (
  SELECT doc_id, length(text) - length(replace(text, ',', '')) AS c,
         length(text) - length(replace(text, '.', '')) AS d FROM documents),
scored AS (
  SELECT doc_id, c / (c + d + 1)::DOUBLE AS n, 1 / (c + d + 1)::DOUBLE AS u,
         d / (c + d + 1)::DOUBLE AS p FROM counted)
SELECT doc_id,
       CASE WHEN p > u * 0.6::DOUBLE THEN 'positive' WHEN n > u * 1.5 THEN 'negative'
            ELSE 'neutral' END AS sent_label,
       round(CASE WHEN p > u * 0.6::DOUBLE THEN p WHEN n > u * 1.5 THEN n ELSE u END, 6)
         AS sent_score
FROM scored
"""


def _review_steps(limit: str) -> str:
    joined = f"""
    SELECT c.conv_id, c.turn, c.text, s.role AS subreddit, s.text AS sub_name
    FROM conversations AS c JOIN (
      SELECT * FROM conversations
      WHERE turn = 0 AND role IN ({", ".join(f"'{c}'" for c in S.COMMUNITIES)}) {limit}) AS s
      ON s.conv_id = c.conv_id
    WHERE c.turn > 0 AND {_any_word("s.text", S.WEATHER_WORDS)}
      AND {_any_word("c.text", S.WEATHER_WORDS)} AND {_any_word("c.text", S.GEAR_WORDS)}
    """
    keys = "conv_id, turn, subreddit, sub_name, text"
    return f"""
{_mentions(joined, keys, 12)},
counted AS (
  SELECT *, {_count("brand_context", S.POSITIVE)} AS pc, {_count("brand_context", S.NEGATIVE)} AS nc
  FROM found),
scored AS (
  SELECT *, nc / (pc + nc + 1)::DOUBLE AS n, 1 / (pc + nc + 1)::DOUBLE AS u,
         pc / (pc + nc + 1)::DOUBLE AS p FROM counted),
reviews AS (
  SELECT subreddit, sub_name, 'c/' || conv_id AS sub_link, conv_id * 1000 + turn AS comment_created,
         text AS comment_body, {_first_word("text", S.WEATHER_WORDS)} AS weather_season,
         {_first_word("text", S.GEAR_WORDS)} AS gear_type, gear_brand, brand_context,
         CASE WHEN p > u * 0.6::DOUBLE THEN 'positive' WHEN n > u * 1.5 THEN 'negative'
              ELSE 'neutral' END AS sent_label,
         round(CASE WHEN p > u * 0.6::DOUBLE THEN p WHEN n > u * 1.5 THEN n ELSE u END, 6)
           AS sent_score
  FROM scored)
"""


_HOT = f"QUALIFY row_number() OVER (PARTITION BY role ORDER BY conv_id) <= {HOT_SUBMISSIONS}"
ORACLES["gear_reviews"] = f"WITH {_review_steps(_HOT)} SELECT * FROM reviews"
_FEW = "QUALIFY row_number() OVER (PARTITION BY role ORDER BY conv_id) <= 10"
ORACLES["gear_reviews_few"] = f"""
WITH {_review_steps(_FEW)} SELECT * FROM reviews WHERE subreddit = '{S.COMMUNITIES[0]}'
"""
ORACLES["gear_reviews_all_submissions"] = f"WITH {_review_steps('')} SELECT * FROM reviews"
ORACLES["append_roundtrip"] = f"""
WITH trails AS ({ORACLES["trail_weather"]}), reviewed AS ({ORACLES["gear_reviews"]})
SELECT 'trail' AS kind, name AS label, weather_date AS detail, rain_sum AS number FROM trails
UNION ALL SELECT 'trail', name, NULL, NULL FROM trails
UNION ALL SELECT 'review', gear_brand, brand_context, round(sent_score::FLOAT::DOUBLE, 4) FROM reviewed
"""
ORACLES["comment_walk"] = """
SELECT doc_id::VARCHAR AS submission_id, doc_id || '-' || i AS comment_id, 'level ' || i AS body, i::INTEGER AS depth
FROM documents, unnest(range(0, doc_id % 9 + 1)) AS u(i) WHERE i % 4 <> 3
"""
ORACLES["element_file_scan"] = f"""
WITH {_ELEMENTS}
SELECT row_number() OVER (ORDER BY ord) - 1 AS place, ord AS id, type, CASE WHEN type = 'node' THEN base END AS lat,
       surface, 5 + (sac_scale IS NOT NULL)::BIGINT + (trail_visibility IS NOT NULL)::BIGINT AS n_tags, wkt
FROM els LEFT JOIN lines USING (ord)
"""
ORACLES["resumed_lookup"] = """
WITH placed AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer),
batched AS (
  SELECT *, i // 10 AS batch_id, i % 10 AS batch_pos, min(c_custkey) OVER w AS first, count(*) OVER w AS n
  FROM placed WINDOW w AS (PARTITION BY i // 10))
SELECT c_custkey, CASE WHEN first // 10 % 3 = 0 THEN 'second' ELSE 'first' END AS run, n, batch_id, batch_pos
FROM batched WHERE c_custkey % 5 <> 0
"""
ORACLES["trail_fetched_weather"] = f"""
WITH {_ELEMENTS}, {_winners("place = 1")},
asked AS (
  SELECT lat, lon, row_number() OVER (ORDER BY first_ord, segs.ord) - 1 AS i
  FROM segs JOIN cents USING (ord) WHERE place = 1),
answered AS (
  SELECT *, count(*) OVER w AS n, arg_min(lat, i) OVER w AS first FROM asked WINDOW w AS (PARTITION BY i // 10)),
records AS (
  SELECT lat, lon, max(i) AS i, arg_max(n, i) AS n, arg_max(first, i) AS first
  FROM answered WHERE i % 10 <> 7 GROUP BY lat, lon)
SELECT name, surface, '{S.DAY}' AS weather_date, (r.i % 10)::DOUBLE AS temperature_2m_max, r.n::DOUBLE AS rain_sum,
       r.first AS showers_sum,
       CASE WHEN r.i IS NOT NULL THEN strftime(make_timestamp(floor(l.lat)::BIGINT * 1000000), '%Y-%m-%d %H:%M:%S') END AS sunrise,
       wkt AS geometry
FROM located AS l LEFT JOIN records AS r ON l.lat = r.lat AND l.lon = r.lon
"""
ORACLES["load_once"] = f"""
WITH {_ELEMENTS}, {_winners("place = 1")}, reviewed AS ({ORACLES["gear_reviews"]}),
rows AS (
  SELECT 'trail' AS kind, name AS label, wkt AS detail FROM located
  UNION ALL SELECT 'review', gear_brand, brand_context FROM reviewed)
SELECT * FROM rows UNION ALL SELECT * FROM rows
"""


def _load_report(where: str, deduplicate: str) -> str:
    return f"""
SELECT {deduplicate} AS deduplicate, count(*) AS segments, count(DISTINCT name) AS unique_names,
       count(*) FILTER (n < 2) AS too_short, count(*) FILTER (n >= 2 AND {where}) AS coordinates,
       (count(*) FILTER (n >= 2 AND {where}) + 9) // 10 AS batches,
       (SELECT count(*) FROM (SELECT DISTINCT lat, lon FROM segs JOIN cents USING (ord) WHERE {where})) AS rows
FROM segs"""


ORACLES["load_report"] = f"""
WITH {_ELEMENTS} {_load_report("place = 1", "true")} UNION ALL {_load_report("true", "false")}
"""
ORACLES["many_keywords"] = rf"""
WITH found AS (
  SELECT doc_id, regexp_extract_all({_SHADOW.format("lower(text)").replace("'x'", "'0'")}, '\b(?:[a-z]{{2}}|[aeiou][a-z]{{2}})\b') AS g
  FROM documents)
SELECT doc_id, len(g) AS n, g[1] AS first FROM found
"""
ORACLES["model_scores_by_length"] = """
WITH cut AS (SELECT doc_id, coalesce(left(text, 256), '') AS t FROM documents),
sized AS (
  SELECT *, list_min(list_filter([1, 2, 4, 8, 16, 32, 64, 128, 256], lambda p: p >= length(t))) AS padded FROM cut)
SELECT doc_id, length(t) / (2 * padded)::DOUBLE AS negative, 1 / padded::DOUBLE AS neutral,
       (length(t) - length(replace(t, ' ', ''))) / padded::DOUBLE AS positive
FROM sized
"""
ORACLES["landed_threads"] = """
SELECT c.conv_id || '-' || c.turn AS comment_id, c.conv_id::VARCHAR AS submission_id, 'comment' AS kind, c.text AS body,
       (c.conv_id * 1000 + c.turn)::DOUBLE AS created_utc, s.role AS subreddit, s.text AS title, s.conv_id::INTEGER AS hot_rank
FROM conversations AS c LEFT JOIN (SELECT * FROM conversations WHERE turn = 0) AS s USING (conv_id) WHERE c.turn > 0
"""
