"""Header check and refused lines of the text tables."""

import gzip

import pytest

import marquee as M
from marquee.sources.schemas import FILE_NAMES, SCHEMAS
from marquee.sources.tables import files_without_header, header_of, read_table, read_table_checked

GOOD = ["tt1\tmovie\tA \"quoted\" title\tA\t0\t1999\t\\N\t90\tDrama", "tt2\tshort\tB\tB\t\\N\t\\N\t\\N\t\\N\t\\N", "tt3\tmovie\t\tC\t0\t2000\t\\N\t90\tx,y"]
BAD = ["tt4\tmovie\tD\tD\tmany\t1999\t\\N\t90\tDrama", "tt5\tmovie\tE\tE\t0\t19x9\t\\N\t90\tDrama", "tt6\tmovie\tF", "tt7\tmovie\tG\tG\t0\t1999\t\\N\t90\tDrama\tone more"]
NO_KEY = "\\N\tmovie\tH\tH\t0\t1999\t\\N\t90\tDrama"


def _write(path, lines, header=None, compress=False):
    text = "\n".join([header_of("title_basics") if header is None else header, *lines]) + "\n"
    path.write_bytes(gzip.compress(text.encode()) if compress else text.encode())
    return str(path)


@pytest.mark.parametrize("compress", [False, True])
def test_lines_are_kept_or_refused(spark, tmp_path, compress):
    path = _write(tmp_path / ("t.tsv.gz" if compress else "t.tsv"), [*GOOD, *BAD, NO_KEY], compress=compress)
    kept, refused = read_table_checked(spark, "title_basics", path)
    assert kept.schema == SCHEMAS["title_basics"]
    assert sorted(r.tconst for r in kept.collect()) == ["tt1", "tt2", "tt3"]
    got = {r.line: r.reason for r in refused.collect()}
    assert got == {**dict.fromkeys(BAD, "malformed"), NO_KEY: "no key"}
    assert {r.table for r in refused.collect()} == {"title_basics"} and all(r.file.endswith(path.rsplit("/", 1)[1]) for r in refused.collect())
    # whatever a query reads, the split is the same
    assert kept.count() == 3 and kept.select("tconst").count() == 3 and refused.count() == 5 and refused.select("reason").count() == 5
    plain = read_table(spark, "title_basics", path).where("tconst in ('tt1', 'tt2', 'tt3')")
    assert kept.exceptAll(plain).count() == 0 and plain.exceptAll(kept).count() == 0


def test_swapped_columns_are_an_error(spark, tmp_path):
    names = header_of("title_basics").split("\t")
    names[5], names[6] = names[6], names[5]
    folder = tmp_path / "many"
    folder.mkdir()
    _write(folder / "a.tsv", GOOD)
    wrong = _write(folder / "b.tsv", GOOD, header="\t".join(names))
    with pytest.raises(ValueError, match="no header line.*b.tsv"):
        read_table_checked(spark, "title_basics", str(folder))
    assert [r.file.rsplit("/", 1)[1] for r in files_without_header(spark, "title_basics", str(folder)).collect()] == ["b.tsv"]
    with pytest.raises(ValueError, match="no header line"):
        read_table_checked(spark, "title_basics", _write(tmp_path / "none.tsv", GOOD[1:], header=GOOD[0]))
    assert wrong


def test_empty_table_and_whole_catalogue(spark, tmp_path):
    for name, file in FILE_NAMES.items():
        lines = [*GOOD, BAD[0]] if name == "title_basics" else ["tt1\t8.5\tmany"] if name == "title_ratings" else []
        (tmp_path / file).write_text("\n".join([header_of(name), *lines]) + "\n")
    cat, refused = M.load_catalogue_checked(spark, str(tmp_path))
    assert cat.title_basics.count() == 3 and cat.name_basics.count() == 0 and cat.title_ratings.count() == 0
    assert sorted((r.table, r.reason) for r in refused.collect()) == [("title_basics", "malformed"), ("title_ratings", "malformed")]
    assert M.title_collection(cat, "movie").count() == 2
