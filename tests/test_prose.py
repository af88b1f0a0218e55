"""Files with line breaks inside quotes, cut anywhere, against Spark's reader of whole files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantlens.sources import prose, raw

HEADER = "unused\tnum_claims\tpatent_id\tpatent_title\tpatent_date\tpatent_type"
TEXT = f'''{HEADER}
x\t3\tPP1\t"Two\nlines ""quoted""\tand tab"\t2000-01-01\tplant
x\t\tRE2\tNA\t\treissue

x\t1\tA5\t5" disk "of" it\t"a ""b"""\t"c"
x\t1\tB6\t"multi\n\n""\n\tx\n"\t""\t
x\t1\tC7\t"\n"\t"last\n\nfield"\tq
x\t2\tD8\tplain\t"é\n日本"\tr'''


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("prose")
    (folder / "1.tsv").write_text(TEXT)
    (folder / "2.tsv").write_text(f'{HEADER}\ny\t1\tZ\t"never closed\nto the end')
    (folder / "3.tsv").write_text(HEADER)
    return str(folder)


@pytest.fixture
def cut(spark):
    """Sets how many bytes a split has."""
    names = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}

    def to(size):
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield to
    for name, value in before.items():
        spark.conf.set(name, value)


def whole(spark, path):
    options = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": True}
    return spark.read.options(**options).csv(path)


@pytest.mark.parametrize("size", [10_000, 90, 29])
def test_cut_files_have_the_same_rows(spark, rows, files, cut, size):
    wanted = rows(whole(spark, files))
    cut(size)
    found = prose.read_delimited(spark, files)
    assert rows(found) == wanted and len(wanted) == 7


def test_one_file_is_read_by_many_tasks(spark, rows, files, cut):
    cut(40)
    one = prose.read_delimited(spark, f"{files}/1.tsv")
    assert one.rdd.getNumPartitions() >= len(TEXT.encode()) // 40
    assert one.filter("patent_id = 'B6'").first().patent_title == 'multi\n\n"\n\tx\n'


def test_random_files(spark, rows, tmp_path, cut):
    rng = np.random.default_rng(3)
    symbols = np.array(list('ab"\n\t'))
    field = lambda: "".join(rng.choice(symbols, rng.integers(0, 9)))
    quoted = lambda text: '"' + text.replace('"', '""') + '"'
    plain = lambda text: "p" + text.replace("\n", "").replace("\t", "")
    lines = ["\t".join(quoted(field()) if rng.random() < 0.6 else plain(field()) for _ in range(3)) for _ in range(300)]
    (tmp_path / "f.tsv").write_text("\n".join(["a\tb\tc", *lines]) + "\n")
    wanted = rows(whole(spark, str(tmp_path)))
    assert len(wanted) == 300
    cut(700)
    assert rows(prose.read_delimited(spark, str(tmp_path))) == wanted


def test_windows_line_ends_and_gzip(spark, rows, tmp_path):
    import gzip

    (tmp_path / "g_patent_abstract.tsv").write_bytes(b'patent_id\tpatent_abstract\r\n1\t"a\r\nb"\r\n2\tc\r\n')
    (tmp_path / "z.tsv.gz").write_bytes(gzip.compress(b'patent_id\tpatent_abstract\n1\t"a\nb"\n'))
    assert rows(raw.read_raw(spark, str(tmp_path), "g_patent_abstract")) == [("1", "a\nb"), ("2", "c")]
    assert rows(prose.read_delimited(spark, str(tmp_path / "z.tsv.gz"))) == [("1", "a\nb")]


def test_states_after_lines():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 12))
        out, into, start = rng.random(n) < 0.5, rng.random(n) < 0.5, bool(rng.random() < 0.5)
        wanted, inside = [], start
        for o, i in zip(out, into):
            inside = bool(i if inside else o)
            wanted.append(inside)
        assert prose.states_after(out, into, start).tolist() == wanted


def test_long_fields_do_not_overflow(spark, tmp_path):
    long = "x" * 200_000 + '"" ' * 50_000
    (tmp_path / "f.tsv").write_text(f'a\tb\n1\t"{long}\n{long}"\n' + "\t".join(["2"] * 2) + "\n")
    found = prose.read_delimited(spark, str(tmp_path))
    assert sorted(r.n for r in found.select(F.length("b").alias("n")).collect()) == [1, 2 * (200_000 + 100_000) + 1]
