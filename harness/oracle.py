"""Oracle SQL (DuckDB) for every registered query.

Each statement derives the five catalogue tables from the driver's views in
``WITH`` clauses (the same SQL as FIXTURES.md), then computes the flattened
answer directly with flat joins and window functions — no nesting — so it is
an independent route to the same rows. Element positions are ``row_number``
over the order the Spark side sorts arrays by: a struct's natural order is
field by field with nulls first.
"""

from __future__ import annotations

from harness.registry import DIRECTOR, SEARCH_PATTERN, SERIES_TITLE

FIXTURE_CTES = """
title_basics AS (
 SELECT concat('tt',o_orderkey) AS tconst,
  CASE o_orderstatus WHEN 'F' THEN 'movie' WHEN 'P' THEN 'short' ELSE 'tvEpisode' END AS titleType,
  concat('Title ',o_orderkey % 4000) AS primaryTitle, concat('Original ',o_orderkey) AS originalTitle,
  CAST(CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS INT) AS isAdult,
  CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INT) END AS startYear,
  CAST(NULL AS INT) AS endYear,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(20 + o_orderkey % 160 AS INT) END AS runtimeMinutes,
  CASE WHEN o_orderkey % 20 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN substr(o_orderpriority,3)
       ELSE concat(substr(o_orderpriority,3),',G',o_orderkey % 7) END AS genres
 FROM orders
 UNION ALL
 SELECT concat('tc',c_custkey),'tvSeries',concat('Series ',c_custkey % 1400),c_name,CAST(0 AS INT),
  CAST(1950 + c_custkey % 70 AS INT), CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(1955 + c_custkey % 70 AS INT) END,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(20 + c_custkey % 60 AS INT) END,
  CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE c_mktsegment END
 FROM customer),
name_basics AS (
 SELECT concat(CASE WHEN s_suppkey % 17 = 5 THEN 'nx' ELSE 'nm' END,s_suppkey) AS nconst, concat('Person ',s_suppkey % 95) AS primaryName,
  CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE CAST(1900 + s_suppkey % 100 AS INT) END AS birthYear,
  CASE WHEN s_suppkey % 3 = 0 THEN CAST(1980 + s_suppkey % 40 AS INT) ELSE NULL END AS deathYear,
  CASE WHEN s_suppkey % 9 = 0 THEN NULL WHEN s_suppkey % 2 = 0 THEN 'actor' ELSE 'actor,director' END AS primaryProfession,
  CASE WHEN s_suppkey % 10 = 0 THEN NULL WHEN s_suppkey % 10 = 1 THEN concat('tt',s_suppkey)
       ELSE concat('tt',s_suppkey * 7, ', tt',s_suppkey * 13, ',tt99999999') END AS knownForTitles
 FROM supplier),
title_episode AS (
 SELECT concat('tt',o_orderkey) AS tconst,
  CASE WHEN o_orderkey % 100 = 0 THEN NULL WHEN o_custkey % 11 = 0 THEN concat('tx',o_custkey) ELSE concat('tc',o_custkey) END AS parentTconst,
  CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE CAST(year(o_orderdate) - 1991 AS INT) END AS seasonNumber,
  CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE CAST(month(o_orderdate) AS INT) END AS episodeNumber
 FROM orders WHERE o_orderstatus NOT IN ('F','P')),
title_principals AS (
 SELECT tconst, CAST(row_number() OVER (PARTITION BY tconst ORDER BY a, b, d) AS INT) AS ordering, nconst,
  CASE c WHEN 0 THEN 'actor' WHEN 1 THEN 'actress' WHEN 2 THEN 'director' WHEN 3 THEN 'writer' ELSE 'producer' END AS category,
  CASE c WHEN 3 THEN 'screenplay' ELSE NULL END AS job,
  CASE WHEN c < 2 THEN concat('["Role ',nconst,'"]') ELSE NULL END AS characters
 FROM (SELECT concat('tt',l_orderkey) AS tconst, CAST(l_linenumber AS BIGINT) AS a, l_partkey AS b, l_suppkey AS d,
         concat('nm',l_suppkey) AS nconst, l_partkey % 5 AS c FROM lineitem
       UNION ALL
       SELECT concat(CASE WHEN o_orderkey % 4 = 0 THEN 'tc' ELSE 'tx' END,o_custkey), o_orderkey, 0, 0, concat('nm',o_orderkey % 100), o_orderkey % 5
       FROM orders) x),
title_ratings AS (
 SELECT concat(CASE WHEN o_orderkey % 5 = 0 THEN 'tx' ELSE 'tt' END,o_orderkey) AS tconst, CAST(10 + o_orderkey * 7919 % 91 AS DOUBLE) / 10 AS averageRating,
  CAST(o_orderkey * 104729 % 20000 AS INT) AS numVotes FROM orders
 UNION ALL
 SELECT concat(CASE WHEN c_custkey % 5 = 0 THEN 'txc' ELSE 'tc' END,c_custkey), CAST(10 + c_custkey * 7919 % 91 AS DOUBLE) / 10,
  CAST(c_custkey * 104729 % 20000 AS INT) FROM customer),
credits AS (
 SELECT p.tconst, p.ordering, n.primaryName AS name, p.category, p.job, p.characters, p.nconst,
        n.birthYear, n.deathYear, n.primaryProfession
 FROM title_principals p LEFT JOIN name_basics n ON p.nconst = n.nconst),
credits_pos AS (
 SELECT *, CAST(row_number() OVER (PARTITION BY tconst ORDER BY ordering NULLS FIRST, name NULLS FIRST,
        category NULLS FIRST, job NULLS FIRST, characters NULLS FIRST, nconst NULLS FIRST, birthYear NULLS FIRST,
        deathYear NULLS FIRST, primaryProfession NULLS FIRST) - 1 AS INT) AS pos
 FROM credits),
rated AS (
 SELECT t.*, r.numVotes, r.averageRating FROM title_basics t LEFT JOIN title_ratings r ON r.tconst = t.tconst),
eps AS (
 SELECT e.parentTconst, b.primaryTitle AS Title, b.isAdult AS ep_isAdult, b.startYear AS ep_year,
        b.runtimeMinutes AS runtime, e.seasonNumber AS Season, e.episodeNumber AS Episode,
        r.numVotes AS ep_numVotes, r.averageRating AS ep_averageRating
 FROM title_episode e LEFT JOIN title_basics b ON b.tconst = e.tconst
      LEFT JOIN title_ratings r ON r.tconst = e.tconst
 WHERE e.parentTconst IS NOT NULL),
eps_pos AS (
 SELECT *, CAST(row_number() OVER (PARTITION BY parentTconst ORDER BY Title NULLS FIRST, ep_isAdult NULLS FIRST,
        ep_year NULLS FIRST, runtime NULLS FIRST, Season NULLS FIRST, Episode NULLS FIRST,
        ep_numVotes NULLS FIRST, ep_averageRating NULLS FIRST) - 1 AS INT) AS pos
 FROM eps)
"""

PEOPLE_COLS = ("c.pos, c.ordering, c.name, c.category, c.job, c.characters, c.nconst, c.birthYear, c.deathYear, "
               "c.primaryProfession")
EPISODE_COLS = ("e.pos, e.Title AS ep_title, e.ep_isAdult, e.ep_year, e.runtime, e.Season, e.Episode, e.ep_numVotes, "
                "e.ep_averageRating")
SHORT_DOC = ("t.tconst, t.primaryTitle AS title, t.originalTitle, t.isAdult, t.startYear AS year, t.runtimeMinutes, "
             "t.genres, t.numVotes, t.averageRating")
SERIES_DOC = ("t.tconst, t.primaryTitle AS title, t.originalTitle, t.isAdult, t.startYear, t.endYear, "
              "t.runtimeMinutes, t.genres, t.numVotes, t.averageRating")

# Best-episode order (rating, votes, then position fields).
EPISODE_RANK_SQL = ("ep_averageRating DESC NULLS LAST, ep_numVotes DESC NULLS LAST, Season NULLS FIRST, "
                    "Episode NULLS FIRST, Title NULLS FIRST, ep_year NULLS FIRST, runtime NULLS FIRST, "
                    "ep_isAdult NULLS FIRST")


def MEAN(c: str) -> str:
    """Exact decimal sum over the count, divided once."""
    return f"CAST(sum(CAST({c} AS DECIMAL(18,4))) AS DOUBLE) / count({c})"


def _parts(cols: str) -> str:
    return ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cols.split())


# Digests of a title's credits and of a series' episodes, all fields of all elements in order.
CONTENT_CTES = f"""
, people_digest AS (
 SELECT tconst, CAST(count(*) AS INT) AS people_count,
  md5(string_agg(concat_ws('|', {_parts("ordering name category job characters nconst birthYear deathYear primaryProfession")}), ';' ORDER BY pos)) AS people_md5
 FROM credits_pos GROUP BY tconst),
episodes_digest AS (
 SELECT parentTconst, CAST(count(*) AS INT) AS episode_count,
  md5(string_agg(concat_ws('|', {_parts("Title ep_isAdult ep_year runtime Season Episode ep_numVotes ep_averageRating")}), ';' ORDER BY pos)) AS episodes_md5
 FROM eps_pos GROUP BY parentTconst)"""
CONTENT_COLS = "p.people_count, p.people_md5, e.episode_count, e.episodes_md5"


def _q(body: str) -> str:
    """``body`` starts with extra CTEs (``, name AS (...)``) or directly with SELECT."""
    body = body.strip()
    if body.startswith(","):
        return "WITH " + FIXTURE_CTES.strip() + body
    return "WITH " + FIXTURE_CTES.strip() + "\n" + body


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _title_docs(type_: str) -> str:
    return _q(f"""
SELECT {SHORT_DOC}, {PEOPLE_COLS}
FROM rated t LEFT JOIN credits_pos c ON c.tconst = t.tconst
WHERE t.titleType = '{type_}'""")


def _actor_importance(key: str) -> str:
    return _q(f"""
, acting AS (
 SELECT c.{key} AS actorName,
        CASE t.titleType WHEN 'movie' THEN 'movies' WHEN 'short' THEN 'short' ELSE 'tvSeries' END AS titleType,
        t.averageRating
 FROM rated t JOIN credits c ON c.tconst = t.tconst
 WHERE t.titleType IN ('movie', 'short', 'tvSeries') AND t.averageRating IS NOT NULL
   AND c.category IN ('actor', 'actress')),
per_type AS (
 SELECT actorName, titleType, {MEAN('averageRating')} AS avgRating, count(*) AS numTitles
 FROM acting GROUP BY actorName, titleType),
means AS (
 SELECT actorName, count(*) AS n, CAST(sum(numTitles) AS BIGINT) AS totalTitles,
        coalesce(max(avgRating) FILTER (WHERE titleType = 'movies'), 0) AS a,
        coalesce(max(avgRating) FILTER (WHERE titleType = 'short'), 0) AS b,
        coalesce(max(avgRating) FILTER (WHERE titleType = 'tvSeries'), 0) AS c
 FROM per_type GROUP BY actorName),
per_actor AS (
 SELECT actorName, (a + b + c) / n AS overall, totalTitles, (a + b + c) / n * totalTitles AS wi FROM means),
best AS (
 SELECT * FROM per_actor ORDER BY wi DESC NULLS LAST, actorName ASC NULLS FIRST LIMIT 10)
SELECT b.actorName, round_even(b.overall, 2) AS overallAvgRating, b.totalTitles,
       b.wi AS weightedImportance,
       CAST(row_number() OVER (PARTITION BY b.actorName ORDER BY p.titleType) - 1 AS INT) AS pos,
       p.titleType, round_even(p.avgRating, 2) AS avgRating, p.numTitles
FROM best b JOIN per_type p ON p.actorName IS NOT DISTINCT FROM b.actorName""")


ORACLE: dict[str, str] = {
    "principals_by_title": _q(f"SELECT c.tconst, {PEOPLE_COLS} FROM credits_pos c"),
    "movies": _title_docs("movie"),
    "shorts": _title_docs("short"),
    "tv_series": _q(f"""
SELECT {SERIES_DOC}, {EPISODE_COLS}
FROM rated t LEFT JOIN eps_pos e ON e.parentTconst = t.tconst
WHERE t.titleType = 'tvSeries'"""),
    "tv_series_people": _q(f"""
SELECT t.tconst, {PEOPLE_COLS}
FROM title_basics t LEFT JOIN credits_pos c ON c.tconst = t.tconst
WHERE t.titleType = 'tvSeries'"""),
    "people": _q("""
, known AS (
 SELECT n.nconst, CAST(x.i - 1 AS INT) AS pos, trim(x.v) AS tconst
 FROM name_basics n, unnest(string_split(n.knownForTitles, ',')) WITH ORDINALITY AS x(v, i))
SELECT n.nconst, n.primaryName, n.birthYear, n.deathYear, n.primaryProfession,
       k.pos, k.tconst, t.primaryTitle AS title, t.startYear AS year
FROM name_basics n LEFT JOIN known k ON k.nconst = n.nconst
     LEFT JOIN title_basics t ON t.tconst = k.tconst"""),
    "titles_view": _q(f"""{CONTENT_CTES}
SELECT t.tconst,
       CASE t.titleType WHEN 'movie' THEN 'movies' WHEN 'short' THEN 'short' ELSE 'tvSeries' END AS titleType,
       t.primaryTitle AS title, t.originalTitle, t.isAdult, t.startYear,
       CASE WHEN t.titleType = 'tvSeries' THEN t.endYear END AS endYear, t.runtimeMinutes, t.genres,
       t.numVotes, t.averageRating, {CONTENT_COLS}
FROM rated t LEFT JOIN people_digest p ON p.tconst = t.tconst
     LEFT JOIN episodes_digest e ON e.parentTconst = t.tconst AND t.titleType = 'tvSeries'
WHERE t.titleType IN ('movie', 'short', 'tvSeries')"""),
    "people_with_titles": _q("""
, credited AS (
 SELECT DISTINCT p.nconst, t.tconst,
        CASE t.titleType WHEN 'movie' THEN 0 WHEN 'tvSeries' THEN 1 ELSE 2 END AS src,
        t.primaryTitle AS title, t.startYear, CASE WHEN t.titleType = 'tvSeries' THEN t.endYear END AS endYear
 FROM title_principals p JOIN title_basics t ON t.tconst = p.tconst
 WHERE t.titleType IN ('movie', 'short', 'tvSeries') AND p.nconst IS NOT NULL)
SELECT n.nconst, n.primaryName, n.birthYear, n.deathYear, n.primaryProfession,
       CASE WHEN c.tconst IS NULL THEN NULL
            ELSE CAST(row_number() OVER (PARTITION BY n.nconst ORDER BY c.src, c.tconst) - 1 AS INT) END AS pos,
       c.tconst, c.title, c.startYear, c.endYear
FROM name_basics n LEFT JOIN credited c ON c.nconst = n.nconst"""),
    "rating_per_genre": _q(f"""
SELECT g AS genre, {MEAN('t.averageRating')} AS avgRating, count(*) AS totalMovies
FROM rated t, unnest(string_split(t.genres, ',')) AS u(g)
WHERE t.titleType = 'movie'
GROUP BY g"""),
    "actor_importance": _actor_importance("name"),
    "actor_importance_by_id": _actor_importance("nconst"),
    "titles_up_to_credit": _q(f"""
, hits AS (
 SELECT tconst, min(ordering) AS cut FROM credits
 WHERE category = 'director' AND name = {_lit(DIRECTOR)} GROUP BY tconst),
kept AS (
 SELECT c.*, CAST(row_number() OVER (PARTITION BY c.tconst ORDER BY c.ordering NULLS FIRST, c.name NULLS FIRST,
        c.category NULLS FIRST, c.job NULLS FIRST, c.characters NULLS FIRST, c.nconst NULLS FIRST,
        c.birthYear NULLS FIRST, c.deathYear NULLS FIRST, c.primaryProfession NULLS FIRST) - 1 AS INT) AS kpos
 FROM credits c JOIN hits h ON h.tconst = c.tconst
 WHERE c.ordering IS NULL OR c.ordering <= h.cut)
SELECT t.tconst, t.primaryTitle AS title, t.numVotes, t.averageRating, c.kpos AS pos, c.ordering, c.name,
       c.category, c.job, c.characters, c.nconst, c.birthYear, c.deathYear, c.primaryProfession
FROM rated t JOIN hits h ON h.tconst = t.tconst LEFT JOIN kept c ON c.tconst = t.tconst
WHERE t.titleType = 'movie'"""),
    "titles_credited": _q(f"""
SELECT {SHORT_DOC}
FROM rated t
WHERE t.titleType = 'movie' AND EXISTS (
  SELECT 1 FROM credits c WHERE c.tconst = t.tconst AND c.category = 'director' AND c.name = {_lit(DIRECTOR)})"""),
    "credits_per_person": _q(f"""
, rows AS (
 SELECT c.nconst, c.name, t.averageRating AS rating, t.titleType AS type
 FROM rated t JOIN credits c ON c.tconst = t.tconst
 WHERE t.titleType IN ('movie', 'tvSeries') AND t.averageRating IS NOT NULL)
SELECT nconst, max(name) AS primaryName,
       CAST(count_if(type = 'movie') AS BIGINT) AS movieCount,
       CAST(count_if(type = 'tvSeries') AS BIGINT) AS tvSeriesCount,
       count(*) AS overallCount, {MEAN('rating')} AS avgRating
FROM rows GROUP BY nconst"""),
    "top_series_episodes": _q(f"""
, best AS (
 SELECT * FROM rated WHERE titleType = 'tvSeries' AND numVotes >= 10000
 ORDER BY averageRating DESC NULLS LAST, numVotes DESC NULLS LAST, tconst LIMIT 10),
ranked AS (
 SELECT *, CAST(row_number() OVER (PARTITION BY parentTconst ORDER BY {EPISODE_RANK_SQL}) - 1 AS INT) AS rpos
 FROM eps WHERE parentTconst IN (SELECT tconst FROM best))
SELECT {SERIES_DOC}, e.rpos AS pos, e.Title AS ep_title, e.ep_isAdult, e.ep_year, e.runtime, e.Season, e.Episode,
       e.ep_numVotes, e.ep_averageRating
FROM best t JOIN ranked e ON e.parentTconst = t.tconst
WHERE e.rpos < 10"""),
    "top_episodes_of": _q(f"""
SELECT e.Title, e.Season, e.Episode, e.ep_averageRating AS Rating, e.ep_numVotes AS Votes,
       e.runtime AS Runtime, e.ep_year AS Year
FROM eps e JOIN title_basics s ON s.tconst = e.parentTconst
WHERE s.titleType = 'tvSeries' AND s.primaryTitle = {_lit(SERIES_TITLE)} AND e.ep_averageRating IS NOT NULL
ORDER BY Rating DESC NULLS LAST, Votes DESC NULLS LAST, Season NULLS FIRST, Episode NULLS FIRST,
         Title NULLS FIRST, Year NULLS FIRST, Runtime NULLS FIRST
LIMIT 10"""),
    "top_rated": _q(f"""
, best AS (
 SELECT * FROM rated WHERE titleType = 'movie' AND averageRating >= 9.0 AND numVotes >= 1000
 ORDER BY averageRating DESC NULLS LAST, numVotes DESC NULLS LAST, tconst LIMIT 10)
SELECT {SHORT_DOC}, {PEOPLE_COLS}
FROM best t LEFT JOIN credits_pos c ON c.tconst = t.tconst"""),
    "episode_runtime_per_series": _q("""
SELECT t.primaryTitle AS title, CAST(sum(e.runtime) AS DOUBLE) / count(e.runtime) AS avgEpisodeRuntime, count(*) AS episodeCount
FROM title_basics t JOIN eps e ON e.parentTconst = t.tconst
WHERE t.titleType = 'tvSeries'
GROUP BY t.primaryTitle"""),
    "search_titles": _q(f"""{CONTENT_CTES}
SELECT {SERIES_DOC}, {CONTENT_COLS}
FROM rated t LEFT JOIN people_digest p ON p.tconst = t.tconst LEFT JOIN episodes_digest e ON e.parentTconst = t.tconst
WHERE t.titleType = 'tvSeries' AND regexp_matches(t.primaryTitle, {_lit('(?i)' + SEARCH_PATTERN)})"""),
    "top_k_elements": _q(f"""
, ranked AS (
 SELECT *, CAST(row_number() OVER (PARTITION BY parentTconst ORDER BY {EPISODE_RANK_SQL}) - 1 AS INT) AS rpos
 FROM eps)
SELECT t.tconst, e.rpos AS pos, e.Title AS ep_title, e.ep_isAdult, e.ep_year, e.runtime, e.Season, e.Episode,
       e.ep_numVotes, e.ep_averageRating
FROM title_basics t LEFT JOIN ranked e ON e.parentTconst = t.tconst AND e.rpos < 3
WHERE t.titleType = 'tvSeries'"""),
    "episodes_by_season": _q("""
, ranked AS (
 SELECT *, CAST(row_number() OVER (PARTITION BY parentTconst ORDER BY Season NULLS FIRST, Episode NULLS FIRST,
        Title NULLS FIRST, ep_year NULLS FIRST, runtime NULLS FIRST, ep_isAdult NULLS FIRST,
        ep_numVotes NULLS FIRST, ep_averageRating NULLS FIRST) - 1 AS INT) AS rpos
 FROM eps)
SELECT t.tconst, e.rpos AS pos, e.Title AS ep_title, e.ep_isAdult, e.ep_year, e.runtime, e.Season, e.Episode,
       e.ep_numVotes, e.ep_averageRating
FROM title_basics t LEFT JOIN ranked e ON e.parentTconst = t.tconst
WHERE t.titleType = 'tvSeries'"""),
}

# The flat-table routes compute the same answers as the collection routes.
for _name in ("actor_importance", "credits_per_person", "people_with_titles", "episode_runtime_per_series",
              "top_series_episodes", "titles_up_to_credit", "titles_credited", "top_episodes_of", "top_rated",
              "search_titles", "titles_view"):
    ORACLE[f"{_name}_from_tables"] = ORACLE[_name]
ORACLE["view_titles_sql"] = ORACLE["titles_view"]
ORACLE["people_with_title_lists"] = ORACLE["people_with_titles_of_collections"] = ORACLE["people_with_titles"]
ORACLE["credits_per_person_of_collections"] = ORACLE["credits_per_person"]
ORACLE["movies_characters_list"] = _q("""
SELECT t.tconst, c.pos, c.ordering, c.nconst,
       replace(replace(c.characters, '["', ''), '"]', '') AS characters
FROM title_basics t LEFT JOIN credits_pos c ON c.tconst = t.tconst
WHERE t.titleType = 'movie'""")

# Stored collections: the same answers by name, by index, in another order on disk; and joins with salted keys.
for _name, _like in (("titles_named_view", "titles_view"), ("people_with_titles_named_view", "people_with_titles"),
                     ("titles_credited_indexed", "titles_credited"), ("top_episodes_of_clustered", "top_episodes_of"),
                     ("principals_by_title_salted", "principals_by_title"), ("principals_by_title_in_parts", "principals_by_title"), ("people_salted", "people")):
    ORACLE[_name] = ORACLE[_like]
# Ratings from 1 to 10 are whole numbers of 2^-52: their sum is exact as such, and rounded once where its digits are read as a double.
ORACLE["rating_per_genre_of_doubles"] = _q("""
SELECT g AS genre,
  CAST(CAST(sum(CAST(t.averageRating * 4503599627370496 AS HUGEINT)) AS VARCHAR) AS DOUBLE) / 4503599627370496 / count(t.averageRating) AS avgRating,
  count(t.averageRating) AS ratedMovies
FROM rated t, unnest(string_split(t.genres, ',')) AS u(g)
WHERE t.titleType = 'movie'
GROUP BY g""")

ORACLE["title_basics_from_text"] = _q("SELECT * FROM title_basics")
