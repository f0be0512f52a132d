"""Sources and sinks: TSV tables, catalogue conversion, collection round trips."""

import gzip
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import marquee as M
from marquee.sources.fixtures import catalogue_from_driver_tables
from marquee.sources.tables import check_keys

from catalogue_rows import SF001


def _write(path, lines, gz=False):
    data = ("\n".join(lines) + "\n").encode()
    if gz:
        with gzip.open(path, "wb") as f:
            f.write(data)
    else:
        with open(path, "wb") as f:
            f.write(data)


def test_tsv_unbalanced_quote_null_token_bad_int(spark, tmp_path):
    p = str(tmp_path / "title.principals.tsv")
    _write(p, [
        "tconst\tordering\tnconst\tcategory\tjob\tcharacters",
        'tt1\t1\tnm1\tself\t\\N\t["Self"]',
        'tt2\tabc\t"Rome\t\\N\t\\N\t\\N',
        'tt3\t2\t"nm3"\tactor\t\\N\t["A \\"B\\""]',
    ])
    rows = {r.tconst: r for r in M.read_table(spark, "title_principals", p).collect()}
    assert rows["tt1"].characters == '["Self"]' and rows["tt1"].job is None
    assert rows["tt2"].ordering is None  # malformed int -> null
    assert rows["tt2"].nconst == '"Rome' and rows["tt2"].category is None  # quote is data, tabs still split
    assert rows["tt3"].nconst == '"nm3"'  # a quoted value keeps its quotes


def test_load_catalogue_reads_one_form_of_each_file(spark, tmp_path):
    base = str(tmp_path)
    lines = {
        "title.basics.tsv": [
            "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres",
            "tt1\tmovie\tA\tA\t0\t1999\t\\N\t90\tDrama,Comedy"],
        "name.basics.tsv": [
            "nconst\tprimaryName\tbirthYear\tdeathYear\tprimaryProfession\tknownForTitles",
            "nm1\tAnn\t1970\t\\N\tactor\ttt1"],
        "title.episode.tsv": ["header"], "title.principals.tsv": ["header"], "title.ratings.tsv": ["header"],
    }
    for name, rows in lines.items():
        _write(f"{base}/{name}", rows)
        _write(f"{base}/{name}.gz", rows, gz=True)
        _write(f"{base}/{name}.bak", rows)
    for suffix in ("", ".gz"):
        cat = M.load_catalogue(spark, base, suffix=suffix)
        assert [r.genres for r in cat.title_basics.collect()] == ["Drama,Comedy"]
        assert [r.primaryName for r in cat.name_basics.collect()] == ["Ann"]
        assert cat.title_ratings.count() == 0
        assert {r.table: r.null_keys for r in check_keys(cat).collect()}["title_basics"] == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        M.load_catalogue(spark, base, suffix=".zst")


def test_write_catalogue_round_trip(spark, tmp_path):
    cat = catalogue_from_driver_tables(spark, SF001)
    out = str(tmp_path / "cat")
    M.write_catalogue(cat, out, partitions=2)
    back = M.load_catalogue(spark, out, fmt="parquet")
    for name, df in cat.tables().items():
        assert back.tables()[name].exceptAll(df).count() == 0
        assert df.exceptAll(back.tables()[name]).count() == 0


def test_collections_round_trip_parquet_and_json(spark, tmp_path):
    colls, shared = M.build_collections(catalogue_from_driver_tables(spark, SF001))
    for fmt in ("parquet", "json"):
        base = str(tmp_path / fmt)
        M.write_collections(colls, base, fmt=fmt, shared=shared)
        back = M.read_collections(spark, base, fmt=fmt)
        for name, df in colls.items().items():
            stored = back.items()[name]
            assert stored.count() == df.count()
            if fmt == "parquet":
                assert stored.schema.simpleString() == df.schema.simpleString()  # readers drop non-null flags
                assert stored.exceptAll(df).count() == 0
    assert all(not df.is_cached for df in shared)


def test_write_collection_partitioned(spark, tmp_path):
    colls, _ = M.build_collections(catalogue_from_driver_tables(spark, SF001))
    titles = M.titles(colls)
    out = str(tmp_path / "titles")
    M.write_collection(titles, out, partition_by=["titleType"], partitions=3)
    parts = sorted(d for d in os.listdir(out) if d.startswith("titleType="))
    assert parts == ["titleType=movies", "titleType=short", "titleType=tvSeries"]
    back = M.read_collection(spark, out).filter(F.col("titleType") == "short")
    assert "PartitionFilters: [isnotnull(titleType" in back._jdf.queryExecution().executedPlan().toString()
    assert back.count() == colls.shorts.count()
