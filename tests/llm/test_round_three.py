"""Positional index, pivot codes and alignment against brute force, and their odd rows."""

import collections
import gzip
import hashlib
import io
import pathlib
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from grantlens.llm import alignment, pivot_codes, positional_index, token_shards, warc
from grantlens.llm.queries import QUERIES, WORD_BPE
from grantlens.sources.storage import written

FOLDER = "/root/testdata/sf0.01"
FILES = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_contamination(docs, items, width):
    windows = collections.defaultdict(set)
    for item, text in items:
        found = words(text)
        n = min(width, len(found))
        for at in range(len(found) - n + 1 if n else 0):
            windows[tuple(found[at : at + n])].add("" if item is None else str(item))
    result = []
    for doc, text in docs:
        found, hit, named = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for at in range(len(found) - n + 1):
                if tuple(found[at : at + n]) in windows:
                    named |= windows[tuple(found[at : at + n])]
                    hit.update(range(at, at + n))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        result.append((doc, len(found), len(hit), len(named), digest, bool(hit)))
    return sorted(result, key=repr)


DOCS = "doc_id long, text string, row string, pos string"
ITEMS = "item_id long, text string, window string, width string"
LONG = " ".join(f"w{i % 97}" for i in range(40_000))
ODD_DOCS = [
    (1, "One, two three FOUR. Five"), (1, "One, two three FOUR. Five"), (2, "...three four five six one two three"), (3, None),
    (4, ""), (5, " ,. "), (None, "zwei ÉÉ éé two three four"), (6, LONG + " one two three four " + LONG), (7, "solo"),
    (8, "one two x three four one two three"), (9, "ÀB'c two\x00three four"),
]
ODD_ITEMS = [
    (10, "one two three four five"), (11, "Three FOUR five"), (11, "Three FOUR five"), (12, None), (13, ""), (14, "?!"),
    (15, "solo"), (None, "ÉÉ éé two"), (16, "two two"), (17, "c two three four"), (18, "absent words here now"), (19, "w1 w2 w3 w4"),
]


@pytest.mark.parametrize("width", [1, 2, 3, 4, 10])
def test_contamination_equals_brute_force(spark, rows, width):
    docs = spark.createDataFrame([(*d, "x", "y") for d in ODD_DOCS], DOCS)
    items = spark.createDataFrame([(*i, "x", "y") for i in ODD_ITEMS], ITEMS)
    got = rows(positional_index.contamination(docs, items, width))
    assert got == plain_contamination(ODD_DOCS, ODD_ITEMS, width)


def test_contamination_of_nothing(spark):
    docs, items = spark.createDataFrame(ODD_DOCS, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    got = positional_index.contamination(docs, items)
    assert got.count() == len(ODD_DOCS) and not got.filter("contaminated OR n_items > 0").count()
    none = spark.createDataFrame([], "doc_id long, text string")
    assert positional_index.contamination(none, spark.createDataFrame(ODD_ITEMS, "item_id long, text string")).count() == 0


def test_contamination_leaves_one_table(spark):
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir")) / "grantlens"
    shared.mkdir(exist_ok=True)
    before = set(shared.iterdir())
    docs = spark.createDataFrame(ODD_DOCS, "doc_id long, text string")
    positional_index.contamination(docs, spark.createDataFrame(ODD_ITEMS, "item_id long, text string"))
    assert [p.name.split("-")[0] for p in set(shared.iterdir()) - before] == ["contamination"]


def plain_near(text, window, span):
    """(start, stop) for each occurrence of the window's rarest word: the shortest, then leftmost stretch that holds it."""
    found, wanted = words(text), set(window)
    rarest = min(wanted, key=lambda w: (found.count(w), window.index(w), w))
    result = []
    for anchor in [i for i, w in enumerate(found) if w == rarest]:
        fits = [
            (b - a, a, b)
            for a in range(max(0, anchor - span + 1), anchor + 1)
            for b in range(anchor, min(len(found), a + span))
            if wanted <= set(found[a : b + 1]) and found[a] in wanted
        ]
        if fits:
            _, a, b = min(fits)
            result.append((a, b))
    return result


@pytest.mark.parametrize("span", [4, 7, 12])
def test_near_matches_equal_brute_force(spark, span):
    rng = np.random.default_rng(span)
    text = " ".join(f"v{n}" for n in rng.integers(0, 9, 400))
    windows = [("v1", "v2", "v3"), ("v4", "v5"), ("v6", "v6", "v7", "v0"), ("v8",), ("v1", "none")]
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(i, list(w)) for i, w in enumerate(windows)], "item long, words array<string>")
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/near-{span}"
    positional_index.write_postings(docs, folder)
    got = collections.defaultdict(list)
    for r in positional_index.find_near(positional_index.read_postings(spark, folder), items, span, written).collect():
        got[r.item].append((r.start, r.stop))
    for number, window in enumerate(windows):
        assert sorted(got[number]) == sorted(plain_near(text, window, span)), window


def test_words_of_odd_texts(spark):
    docs = spark.createDataFrame(ODD_DOCS, "doc_id long, text string")
    split = docs.select(F.size(positional_index.words_of(F.col("text"))).alias("n"))
    assert sorted(r.n for r in split.collect()) == sorted(len(words(t)) for _, t in ODD_DOCS)


# ---- pivot codes ------------------------------------------------------------------------------


def plain_codes(vectors, n_entries=64, rounds=2):
    """Every distance in full, in Python's whole numbers; vectors are (vec_id, label, list)."""
    vectors = sorted(vectors, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    whole = [(v, label, [int(np.floor(np.float64(x) * 256)) for x in e]) for v, label, e in vectors]
    d = -(-len(whole[0][2]) // 16)
    parts = [[(q + [0] * (16 * d - len(q)))[p * d : (p + 1) * d] for p in range(16)] for _, _, q in whole]
    books = [[list(parts[e][p]) for e in range(min(n_entries, len(parts)))] for p in range(16)]

    def nearest(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(16):
            groups = collections.defaultdict(list)
            for row in parts:
                groups[nearest(row[p], books[p])[1]].append(row[p])
            for e, members in groups.items():
                books[p][e] = [sum(x) // len(members) for x in zip(*members)]
    found = [[nearest(row[p], books[p]) for p in range(16)] for row in parts]
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    errors = collections.Counter()
    for (_, label, _), near in zip(whole, found):
        errors[label] += sum(n[0] for n in near)
    return sorted(
        (
            (v, "".join(f"{n[1]:02x}" for n in near), sum(n[0] for n in near), errors[label], digest)
            for (v, label, _), near in zip(whole, found)
        ),
        key=repr,
    )


def vectors_of(spark, found):
    extra = [(*row, "mine", 1) for row in found]
    return spark.createDataFrame(extra, "vec_id long, label int, embedding array<float>, code string, n int")


@pytest.mark.parametrize(("n", "size"), [(300, 64), (40, 64), (120, 20), (1, 3)])
def test_pivot_codes_equal_brute_force(spark, rows, n, size):
    rng = np.random.default_rng(n)
    values = rng.normal(0, 0.3, (n, size)).astype(np.float32)
    values[n // 2 :] = values[: n - n // 2]  # copies, so that entries and distances tie
    values[0] = 0
    found = [(None if i == 5 else i // 2, [0, 1, None][i % 3], v.tolist()) for i, v in enumerate(values)]
    assert rows(pivot_codes.compress(vectors_of(spark, found))) == plain_codes(found)


def test_pivot_codes_of_odd_vectors(spark):
    good = [(i, 0, [float(i + j) for j in range(16)]) for i in range(4)]
    odd = [(10, 0, None), (11, 0, []), (12, 0, [1.0] * 15 + [float("nan")]), (13, 0, [1.0] * 15 + [float("inf")]), (14, 0, [1.0] * 15 + [None])]
    huge = [(20, 0, [3e38] * 8 + [-3e38] * 8), (21, 0, [1.0] * 17)]
    got = pivot_codes.compress(vectors_of(spark, good + odd + huge)).collect()
    assert sorted(r.vec_id for r in got) == [0, 1, 2, 3, 20]
    assert all(r.error >= 0 for r in got)
    none = pivot_codes.compress(vectors_of(spark, odd))
    assert none.collect() == [] and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_pivots_prune_and_change_nothing():
    rng = np.random.default_rng(1)
    points, entries = rng.integers(-200, 200, (5000, 4)), rng.integers(-200, 200, (64, 4))
    pivots = pivot_codes.choose_pivots(entries[None])
    far = pivot_codes.distances(points[:, None], pivots)[:, 0]
    index, squared, computed = pivot_codes.nearest(points, far, entries, pivot_codes.distances(entries[:, None], pivots)[:, 0])
    full = ((points[:, None] - entries) ** 2).sum(axis=2)
    assert np.array_equal(index, full.argmin(axis=1)) and np.array_equal(squared, full.min(axis=1))
    assert computed < 0.25 * full.size


# ---- alignment --------------------------------------------------------------------------------


def plain_alignment(docs):
    """Both token rows walked together, one token at a time, over whole texts."""
    first, second = alignment.ByteTokens(FILES[0]), alignment.PieceTokens(FILES[1])
    links, facts, counts = [], [], collections.Counter()
    for doc, text in docs:
        a, b = (first.encode([text])[0], second.encode([text])[0]) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or any(b"".join(side.bytes[i] for i in ids) != raw for side, ids in ((first, a), (second, b))):
            links.append([])
            facts.append((doc, 0, 0, 0, ""))
            continue
        i = j = x = y = 0
        end_a, end_b, groups, own = len(first.bytes[a[0]]), len(second.bytes[b[0]]), [], [(a[0], b[0])]
        while True:
            if end_a == end_b:
                groups.append(",".join(map(str, a[x : i + 1])) + "|" + ",".join(map(str, b[y : j + 1])))
                i, j = i + 1, j + 1
                x, y = i, j
                if i == len(a):
                    break
                end_a, end_b = end_a + len(first.bytes[a[i]]), end_b + len(second.bytes[b[j]])
            elif end_a < end_b:
                i += 1
                end_a += len(first.bytes[a[i]])
            else:
                j += 1
                end_b += len(second.bytes[b[j]])
            own.append((a[i], b[j]))
        links.append(own)
        facts.append((doc, len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        counts.update(set(own))
    best = collections.Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return sorted(
        (
            (doc, n_a, n_b, n, len(own), sum(counts[x] == best[x[0]] for x in own), sum(counts[x] for x in own), digest)
            for (doc, n_a, n_b, n, digest), own in zip(facts, links)
        ),
        key=repr,
    )


STRANGE = [
    "a  b", "  lead", "tail ", "tail\n", "x\n y", "x \ny", "a   b", "one  two", "▁x", "x ▁ y", "<|endoftext|> <s> </s>", "é é ﬁ ½ İ.",
    "日本語 テキスト", "😀 a😀b", "\t", " ", "\x00", "a\x00 b", "I've it's 12,345.67 $%^", "​ 　 z", "don't  \n\n  stop", "\x1c x", "x\x85 y",
    "<0x41> <0x0A>", "word " * 3000, "x" * 3000 + " y",
]


def test_alignment_of_odd_texts(spark, rows, monkeypatch):
    found = [(i, text) for i, text in enumerate([None, "", *STRANGE, "a  b", "plain words"])] + [(3, "plain words"), (None, "plain words")]
    docs = spark.createDataFrame([(*d, 7) for d in found], "doc_id long, text string, n_a int")
    assert rows(alignment.align(docs, *FILES)) == plain_alignment(found)
    assert alignment.align(docs.limit(0), *FILES).count() == 0


def test_pieces_equal_whole_texts():
    """Random texts of letters, marks and all kinds of white space, cut into pieces and whole."""
    rng = np.random.default_rng(7)
    alphabet = list("abcde ABé日😀.,'1\n\t") + [" "] * 12 + [" ", "▁", " ", "\x1c", "\x85"]
    texts = ["".join(rng.choice(alphabet, rng.integers(1, 40))) for _ in range(4000)]
    pieces = alignment.Pieces(alignment.ByteTokens(FILES[0]), alignment.PieceTokens(FILES[1]))
    got = pieces.describe(texts)
    whole = {r[0]: r for r in plain_alignment(list(enumerate(texts)))}
    for number, (facts, digest, pairs, times) in enumerate(got):
        assert (*facts.tolist(), digest) == (*whole[number][1:5], whole[number][7]), repr(texts[number])
        assert times.sum() == whole[number][4] and len(pairs) == len(times)


def test_small_chunks_and_caches_change_nothing(spark, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    one = alignment.Pieces(alignment.ByteTokens(FILES[0]), alignment.PieceTokens(FILES[1]))
    monkeypatch.setattr(alignment, "MOST_PIECES", 50)
    monkeypatch.setattr(alignment, "LONGEST_PIECE", 4)
    small = alignment.Pieces(one.first, one.second)
    parts = [x for at in range(0, 60, 7) for x in small.describe(texts[at : at + 7])]
    for a, b in zip(one.describe(texts), parts, strict=True):
        assert a[1] == b[1] and np.array_equal(a[0], b[0]) and np.array_equal(a[2], b[2]) and np.array_equal(a[3], b[3])


def test_alignment_equals_brute_force(spark, rows):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES["op13_alignment"](spark, FOLDER)) == plain_alignment(docs)


def test_pointers_jump_to_the_last_token():
    ends_a, ends_b = np.array([2, 3, 7, 8, 9]), np.array([1, 3, 5, 6, 9])
    label_a, label_b = alignment.group_labels(ends_a, ends_b)
    assert label_a.tolist() == [1, 1, 4, 4, 4] and label_b.tolist() == [1, 1, 4, 4, 4]


# ---- files read by as many tasks as there are -------------------------------------------------


def test_archives_and_shards_have_a_task_each(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").limit(200).repartition(2)
    place = warc.new_folder(spark)
    n = warc.write_archives(pages, place).count()
    chunks = warc.read_chunks(spark, place)
    told = chunks.select("archive", F.spark_partition_id().alias("task")).distinct().collect()
    assert n > 8 and len({r.task for r in told}) == n
    plan = warc.page_records(chunks)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Sort" not in plan
    fits = chunks.filter("is_last AND record_type = 'response'").select("digest_fits").distinct().collect()
    assert [r.digest_fits for r in fits] == [True]

    shards = token_shards.new_folder(spark)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(300)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert token_shards.write_shards(docs, shards, WORD_BPE).count() == 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    listed = token_shards.list_shards(spark, shards)
    assert listed.rdd.getNumPartitions() == token_shards.read_manifest(spark, shards).count()
    asked = docs.select("doc_id").union(spark.createDataFrame([(-5,), (None,)], "doc_id long"))
    found = {r.doc_id: (r.start, len(r.ids)) for r in token_shards.lookup(asked, shards).collect()}
    assert found == {r.doc_id: (r.start, r.n_tokens) for r in listed.collect()}


def test_ordinary_archives(tmp_path):
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>hello</p>"
    digest = warc.base32(hashlib.sha1(b"<p>hello</p>").digest())

    def record(kind, block, *more):
        head = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Date: 2024-01-01T00:00:00Z", f"Content-Length: {len(block)}", *more]
        return gzip.compress(("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n")

    is_http = "Content-Type: application/http; msgtype=response"
    archive = (
        record("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields", "WARC-Record-ID: <urn:uuid:1>")
        + record("request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", "Content-Type: application/http; msgtype=request")
        + record("response", body, is_http, f"WARC-Payload-Digest: sha1:{digest}")
        + record("response", body, is_http, "WARC-Payload-Digest: sha1:WRONG")
        + record("resource", b"raw bytes", "Content-Type: text/plain", "WARC-Payload-Digest: md5:abc")
        + record("metadata", b"")
    )
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(archive)))
    rows = list(warc.record_chunks(stream, chunk_bytes=5))
    last = [r for r in rows if r["is_last"]]
    assert [(r["record_type"], r["bytes_so_far"], r["digest_fits"]) for r in last] == [
        ("warcinfo", 13, None), ("request", 0, None), ("response", 12, True), ("response", 12, False), ("resource", 9, None),
        ("metadata", 0, None),
    ]
    assert b"".join(r["chunk"] for r in rows if r["record_no"] == 3) == b"<p>hello</p>"
    assert last[0]["record_id"] == "<urn:uuid:1>" and last[4]["declared_digest"] == "md5:abc"
