"""Collection builds and queries on hand-written catalogues (FIXTURES §A cases)."""

from pyspark.sql import functions as F

import marquee as M
from marquee.plans import flat

from catalogue_rows import T, make_catalogue


def _cat(spark):
    return make_catalogue(
        spark,
        title_basics=[
            T("tt1", "movie", "Heat", genres="Crime,Drama"),
            T("tt2", "movie", "Unrated", genres=None),          # no rating, null genres
            T("tt3", "movie", "Lonely"),                        # no credits
            T("tt4", "short", "Brief", year=2010),
            T("tc1", "tvSeries", "Game of Thrones", year=2011, end=2019),
            T("tc2", "tvSeries", "GAME OF THRONES x", year=2020),  # no episodes
            T("tc3", "tvSeries", "Other", year=2001),
            T("te1", "tvEpisode", "Winter", year=2011, runtime=60),
            T("te2", "tvEpisode", "Battle", year=2012, runtime=55),
            T("te3", "tvEpisode", "Orphan", year=2012),
            T("te4", "tvEpisode", "No parent", year=2012),
            T("te5", "tvEpisode", "Unrated ep", year=2013, runtime=None),
        ],
        name_basics=[
            ("nm1", "Ann", 1970, None, "actor,director", "tt1, tt4,tt99"),
            ("nm2", "Bob", 1960, 2020, "actor", None),
            ("nm3", "Ann", 1980, None, None, "tt2"),           # namesake of nm1
        ],
        title_episode=[
            ("te1", "tc1", 1, 1), ("te2", "tc1", 1, 2), ("te5", "tc1", 2, 1),
            ("te3", "tt1", 1, 1),   # parent is a movie
            ("te4", None, None, None),
        ],
        title_principals=[
            ("tt1", 2, "nm1", "director", None, None),
            ("tt1", 1, "nm2", "actor", None, '["Neil"]'),
            ("tt1", 3, "nm1", "actor", None, '["Cameo"]'),   # listed twice on one title
            ("tt1", 4, "nm9", "actress", None, None),        # unknown person
            ("tt2", 1, "nm3", "actor", None, None),
            ("tt4", 1, "nm1", "actress", None, None),
            ("tc1", 1, "nm2", "actor", None, None),
            ("te1", 1, "nm2", "actor", None, None),          # episode credits stay out of collections
        ],
        title_ratings=[
            ("tt1", 8.0, 1000), ("tt3", 6.0, 10), ("tt4", 7.0, 50),
            ("tc1", 9.2, 20000), ("tc2", 9.9, 30000), ("tc3", 5.0, 15000),
            ("te1", 9.0, 500), ("te2", 9.0, 800),
        ],
    )


def _build(spark):
    cat = _cat(spark)
    colls, _ = M.build_collections(cat)
    return cat, colls


def test_movie_documents(spark):
    _, colls = _build(spark)
    movies = {r.tconst: r for r in colls.movies.collect()}
    assert colls.movies.columns == ["tconst", "title", "originalTitle", "isAdult", "year", "runtimeMinutes",
                                    "genres", "people", "rating"]
    heat = movies["tt1"]
    assert heat.genres == ["Crime", "Drama"]
    assert [p.ordering for p in heat.people] == [1, 2, 3, 4]
    assert heat.people[3].nconst == "nm9" and heat.people[3].name is None  # unknown person kept
    assert heat.rating.asDict() == {"numVotes": 1000, "averageRating": 8.0}
    assert movies["tt2"].rating.asDict() == {"numVotes": None, "averageRating": None}  # unrated: struct of nulls
    assert movies["tt2"].genres is None
    assert movies["tt3"].people is None


def test_series_episodes_sorted_by_title_and_orphans_dropped(spark):
    _, colls = _build(spark)
    series = {r.tconst: r for r in colls.tvSeries.collect()}
    assert colls.tvSeries.columns[-1] == "episodes"
    assert [e.Title for e in series["tc1"].episodes] == ["Battle", "Unrated ep", "Winter"]
    assert series["tc1"].episodes[0].ordering.asDict() == {"Season": 1, "Episode": 2}
    assert series["tc2"].episodes is None
    all_titles = [e.Title for r in series.values() for e in (r.episodes or [])]
    assert "Orphan" not in all_titles and "No parent" not in all_titles
    assert series["tc1"].people[0].nconst == "nm2" and len(series["tc1"].people) == 1


def test_episodes_by_season(spark):
    cat = _cat(spark)
    s = M.with_episodes(M.title_collection(cat, "tvSeries"), cat, order_by="season_episode")
    eps = s.filter("tconst = 'tc1'").first().episodes
    assert [(e.ordering.Season, e.ordering.Episode) for e in eps] == [(1, 1), (1, 2), (2, 1)]


def test_people_collection(spark):
    _, colls = _build(spark)
    people = {r.nconst: r for r in colls.people.collect()}
    assert colls.people.columns == ["nconst", "primaryName", "birthYear", "deathYear", "primaryProfession",
                                    "mainTitles"]
    assert people["nm1"].primaryProfession == ["actor", "director"]
    assert [(m.tconst, m.title) for m in people["nm1"].mainTitles] == [("tt1", "Heat"), ("tt4", "Brief"),
                                                                        ("tt99", None)]
    assert people["nm2"].mainTitles is None


def test_titles_view_shape(spark):
    _, colls = _build(spark)
    t = M.titles(colls)
    assert t.columns == colls.tvSeries.columns + ["titleType"]
    tags = {r.tconst: (r.titleType, r.startYear, r.endYear, r.episodes) for r in t.collect()}
    assert tags["tt1"] == ("movies", 2000, None, None)
    assert tags["tt4"] == ("short", 2010, None, None)
    assert tags["tc1"][0] == "tvSeries" and tags["tc1"][2] == 2019


def test_rating_per_genre(spark):
    _, colls = _build(spark)
    got = {r.genre: (r.avgRating, r.totalMovies) for r in M.rating_per_genre(colls.movies).collect()}
    # tt2 has null genres and vanishes; tt3 is unrated but counts
    assert got == {"Crime": (8.0, 1), "Drama": (7.0, 2)}


def test_actor_importance_namesakes_merge_and_null_group(spark):
    cat, colls = _build(spark)
    for df in (M.actor_importance(M.titles(colls)), flat.actor_importance(cat)):
        got = {r.actorName: r for r in df.collect()}
        # Ann: actor on tt1 (8.0, movies) + actress on tt4 (7.0, short); nm3 namesake's title is unrated
        assert got["Ann"].totalTitles == 2 and got["Ann"].overallAvgRating == 7.5
        assert [p.titleType for p in got["Ann"].perTitleType] == ["movies", "short"]
        assert got[None].totalTitles == 1  # unknown actress on tt1
        assert got["Bob"].totalTitles == 2 and got["Bob"].weightedImportance == (8.0 + 9.2) / 2 * 2


def test_credits_per_person_counts_duplicates(spark):
    cat, colls = _build(spark)
    for df in (M.credits_per_person(colls.movies, colls.tvSeries), flat.credits_per_person(cat)):
        got = {r.nconst: (r.primaryName, r.movieCount, r.tvSeriesCount, r.overallCount, r.avgRating)
               for r in df.collect()}
        assert got["nm1"] == ("Ann", 2, 0, 2, 8.0)  # twice on tt1
        assert got["nm2"] == ("Bob", 1, 1, 2, (8.0 + 9.2) / 2)
        assert "nm3" not in got  # only credit is on an unrated movie
        assert got["nm9"] == (None, 1, 0, 1, 8.0)


def test_titles_credited_and_up_to_credit(spark):
    _, colls = _build(spark)
    assert [r.tconst for r in M.titles_credited(colls.movies, "Ann", "director").collect()] == ["tt1"]
    assert "people" not in M.titles_credited(colls.movies, "Ann").columns
    assert M.titles_credited(colls.movies, "Ann", "producer").count() == 0
    up = M.titles_up_to_credit(colls.movies, "Ann", "director").first()
    assert [p.ordering for p in up.people] == [1, 2]


def test_top_series_episodes(spark):
    _, colls = _build(spark)
    got = M.top_series_episodes(colls.tvSeries, min_votes=10000, n_series=2, n_episodes=2).collect()
    # tc2 (9.9) ranks first but has no episodes, so only tc1 remains
    assert [r.tconst for r in got] == ["tc1"]
    assert [e.Title for e in got[0].episodes] == ["Battle", "Winter"]  # equal rating, more votes first
    assert "people" not in got[0].asDict()


def test_top_episodes_of_skips_unrated(spark):
    _, colls = _build(spark)
    got = M.top_episodes_of(colls.tvSeries, "Game of Thrones").collect()
    assert [(r.Title, r.Season, r.Episode, r.Votes) for r in got] == [("Battle", 1, 2, 800), ("Winter", 1, 1, 500)]
    assert got[0].Runtime == 55 and got[0].Year == 2012


def test_top_rated(spark):
    _, colls = _build(spark)
    assert [r.tconst for r in M.top_rated(colls.movies, 7.0, 100).collect()] == ["tt1"]
    assert M.top_rated(colls.movies).count() == 0


def test_episode_runtime_per_series(spark):
    cat, colls = _build(spark)
    for df in (M.episode_runtime_per_series(colls.tvSeries), flat.episode_runtime_per_series(cat)):
        got = {r.title: (r.avgEpisodeRuntime, r.episodeCount) for r in df.collect()}
        assert got == {"Game of Thrones": (57.5, 3)}


def test_people_with_titles(spark):
    cat, colls = _build(spark)
    for df in (M.people_with_titles(colls), flat.people_with_titles(cat)):
        got = {r.nconst: [(t.tconst, t.startYear, t.endYear) for t in r.allTitles] for r in df.collect()}
        assert got["nm1"] == [("tt1", 2000, None), ("tt4", 2010, None)]  # tt1 once
        assert got["nm2"] == [("tt1", 2000, None), ("tc1", 2011, 2019)]  # movies before series
        assert got["nm3"] == [("tt2", 2000, None)]
        assert "mainTitles" in df.columns


def test_search_titles_case_insensitive(spark):
    _, colls = _build(spark)
    got = sorted(r.tconst for r in M.search_titles(colls.tvSeries, "game of thrones").collect())
    assert got == ["tc1", "tc2"]


def test_register_views(spark):
    _, colls = _build(spark)
    M.register_views(spark, colls)
    assert spark.sql("SELECT count(*) AS n FROM titles").first().n == 7
    assert spark.sql("SELECT size(allTitles) AS n FROM peopleWithTitles WHERE nconst = 'nm2'").first().n == 2
    assert spark.table("movies").filter(F.col("rating.averageRating") > 7).count() == 1
