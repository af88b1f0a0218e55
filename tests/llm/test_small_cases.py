"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for each operator."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from grantlens.llm import (
    graph_search, html_blocks, html_extraction, language, minhash, mixing, packing, rotation_codes, token_shards, url_filter,
    warc, word_encoder,
)

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string"
LONG = " ".join(f"word{i % 5000}" for i in range(60_000))


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [
        (1, "a b c d e f g", "en", "x"),
        (2, "A B C d e f g", "en", "x"),
        (3, None, None, None),
        (4, "", "en", "y"),
        (5, "  \t\n", "en", None),
        (6, "one two", "fr", "y"),
        (7, "ONE  two", "fr", "y"),
        (7, "ONE  two", "fr", "y"),
        (None, "a b c d e f g", None, "x"),
        (None, None, None, "x"),
        (9, LONG, "en", "z"),
        (8, LONG + " tail", "en", "z"),
        (10, "12 34 %%", "en", "z"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, shard int, score string")


def test_minhash(odd_docs, no_docs):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(odd_docs).collect()}
    assert {
        (1, 3, 1, True), (2, 3, 1, False), (None, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True),
        (6, 1, 6, True), (7, 1, 6, False), (None, 0, None, True), (8, 5001, 8, True), (9, 5000, 8, False), (10, 1, 10, True),
    } == got
    assert minhash.near_duplicates(no_docs).count() == 0
    one = minhash.one_of_each(odd_docs.withColumn("n_shingles", F.lit(0)).withColumn("kept", F.lit("?")))
    assert sorted((r.doc_id or 0) for r in one.collect()) == [0, 1, 3, 4, 5, 6, 8, 10]


def test_repeated_rows_leave_one(spark):
    rows = [(5, "same text of some six words"), (5, "same text of some six words"), (6, None), (6, None)]
    left = minhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in left) == [5, 6, 6]


def test_mixing(odd_docs, no_docs, rows):
    clashing = odd_docs.withColumn("target", F.lit("mine")).withColumn("size", F.lit(1))
    mixed = mixing.mix(clashing)
    assert mixed.columns[: len(clashing.columns)] == clashing.columns
    found = mixed.collect()
    assert len(found) == odd_docs.count()
    assert all(0 <= r._mix_copies <= 2 for r in found)
    assert {r._mix_size for r in found if r.text is None} == {0}
    assert rows(mixing.mix(clashing)) == rows(mixed)
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mixed(odd_docs).columns == odd_docs.columns


def test_targets_fill_up(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 1000)], "_mix_source string, source_size long")
    got = {r._mix_source: r.target for r in mixing.source_targets(sizes, (3, 1, 2), 150, 2).collect()}
    assert got == {"a": 20.0, "b": pytest.approx(2995 / 3), None: pytest.approx(5990 / 3)}


def test_url_rules(spark):
    urls = [
        (1, "http://A.Example.NET/en/x?q"), (2, "https://example.com/de/"), (3, "https://example.com/en/"), (4, None),
        (5, "no scheme"), (6, "http://b.org/fr/#t"), (7, "http://notexample.com/de/"), (8, "http://x.net"), (9, "ftp:///net/"),
        (10, "http://net/a://b"), (1, "http://A.Example.NET/en/x?q"), (11, "http://" + "a." * 3000 + "net/" + "p" * 5000),
    ]
    frame = spark.createDataFrame(urls, "page_id long, url string").withColumn("key", F.lit(1)).withColumn("word", F.lit(2))
    block, allow = [("net", "/"), ("example.com", "/de/")], [("example.net", "/en/"), ("org", "/fr/")]
    got = {r.page_id: (r._url_host[:12], r._url_rule, r._url_verdict) for r in url_filter.judge_urls(frame, block, allow).collect()}
    assert got == {
        1: ("a.example.ne", "example.net/en/", "allow"), 2: ("example.com", "example.com/de/", "block"),
        3: ("example.com", None, "allow"), 4: ("", None, "allow"), 5: ("", None, "allow"), 6: ("b.org", "org/fr/", "allow"),
        7: ("notexample.c", None, "allow"), 8: ("x.net", None, "allow"), 9: ("", None, "allow"), 10: ("net", "net/", "block"),
        11: ("a.a.a.a.a.a.", "net/", "block"),
    }
    assert url_filter.judge_urls(frame.limit(0), block, allow).count() == 0
    with pytest.raises(ValueError):
        url_filter.judge_urls(frame, block, block)


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    listed = [str(i) for i in range(0, 20_000, 97)]
    levels = url_filter.build_cascade(listed, universe)
    assert len(levels) > 1
    held = universe.filter(url_filter.in_cascade(F.col("key"), levels)).collect()
    assert sorted(int(r.key) for r in held) == sorted(map(int, listed))
    bits = 64 * sum(len(level.words) for level in levels)
    assert bits < 25 * len(listed)
    assert url_filter.build_cascade([], universe) == []


def test_rotation_codes(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0], 0, ""), (2, [2.0, 0.0, 0.0], 0, ""), (3, [1.0, 0.0, 0.0], 0, ""), (4, [0.0, 1.0, 0.0], 0, ""),
        (5, None, 0, ""), (6, [0.0, 0.0, 0.0], 0, ""), (7, [nan, 1.0, 0.0], 0, ""), (8, [inf, 1.0, 0.0], 0, ""),
        (9, [None, 1.0, 0.0], 0, ""), (10, [1.0, 0.0], 0, ""), (None, [0.0, 1.0, 0.0], 0, ""), (11, [], 0, ""),
        (12, [1e-30, 0.0, 1e-31], 0, ""), (3, [1.0, 0.0, 0.0], 0, ""),
    ]
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in rotation_codes.near_vectors(vectors(spark, rows)).collect()}
    assert got == {
        (1, 4, 1, True), (2, 4, 1, False), (3, 4, 1, False), (12, 4, 1, False), (4, 1, 4, True), (None, 1, 4, False),
        (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True), (11, 0, 11, True),
    }
    assert rotation_codes.near_vectors(vectors(spark, [])).count() == 0


def test_graph_search(spark):
    rows = [
        (0, [1.0, 0.0], 0, ""), (1, [2.0, 0.0], 0, ""), (2, [1.0, 0.0], 0, ""), (3, [0.0, 1.0], 0, ""), (4, None, 0, ""),
        (5, [0.0, 0.0], 0, ""), (6, [float("nan"), 1.0], 0, ""), (None, [1.0, 0.0], 0, ""), (2, [1.0, 0.0], 0, ""), (7, [1.0], 0, ""),
    ]
    frame = vectors(spark, rows)
    got = graph_search.nearest(frame, frame.filter("vec_id IN (0, 4, 5)"), k=5).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.0)]
    empty = vectors(spark, [])
    assert graph_search.nearest(empty, empty).count() == 0
    assert graph_search.nearest(frame, empty).count() == 0


def test_packing(odd_docs, no_docs):
    clashing = odd_docs.withColumn("start", F.lit(1)).withColumn("window", F.lit("w"))
    got = packing.pack(clashing, WORD_BPE).collect()
    whole = {}
    for r in got:
        whole[r.sequence_id] = whole.get(r.sequence_id, 0) + r.length
        assert r.window & (r.window - 1) == 0 and r.window <= 2048
    assert {r.sequence_id: r.window for r in got} == whole
    assert sum(1 for r in got if r.doc_id == 4 and r.doc_tokens == 1) == 1
    assert packing.pack(no_docs, WORD_BPE).count() == 0


def test_token_shards(spark, odd_docs, no_docs):
    place = token_shards.new_folder(spark)
    token_shards.write_shards(odd_docs, place, WORD_BPE)
    listed = token_shards.list_shards(spark, place).orderBy("start").collect()
    ids = [r.doc_id for r in listed]
    assert ids == [None, None, 1, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10]
    starts = np.cumsum([0] + [r.n_tokens for r in listed])[:-1]
    assert [r.start for r in listed] == starts.tolist()
    asked = spark.createDataFrame([(7,), (3,), (404,), (None,)], "doc_id long")
    found = {r.doc_id: r for r in token_shards.lookup(asked, place).collect()}
    assert set(found) == {3, 7} and found[3].ids == [2]
    assert len(found[7].ids) == 2 * listed[8].n_tokens
    one = np.array(found[7].ids[: listed[8].n_tokens], dtype="<u4").tobytes()
    assert zlib.crc32(one) == listed[8].ids_crc32
    place = token_shards.new_folder(spark)
    token_shards.write_shards(no_docs, place, WORD_BPE)
    assert token_shards.list_shards(spark, place).count() == 0


def test_words_with_marks_have_the_ids_of_the_tokenizer():
    encoder = word_encoder.WordEncoder(WORD_BPE)
    words = [base + mark for base in ("BELEDİYESİ", "İ", "a\u0958", "\u09dc", "Σ", "word", "é") for mark in ("", *".,;:!?")]
    words += ["H\u0331", "T\u0308.", "J\u030c", "I\u0307."]
    texts = [*words, " ".join(words), "Yeni BELEDİYESİ. <|endoftext|> ve İ, son"]
    expected = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert [encoder.encode_all([t])[0] for t in texts] == expected
    assert encoder.encode_all(texts) == expected
    assert word_encoder.WordEncoder(WORD_BPE).encode_all(texts) == expected


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(-(2**62), 2**62, 10_000))
    slots = token_shards.PerfectHash.build(keys).slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    index = token_shards.ShardIndex.build(keys.tolist(), [1] * len(keys), 2)
    places, counts, docs = index.find(np.concatenate([keys + 1, keys]))
    assert (places[len(keys) :] == np.arange(len(keys))).all() and (places[: len(keys)] == -1).sum() >= len(keys) - 2


def test_language(odd_docs, no_docs):
    trees = language.learn_trees(odd_docs)
    got = {(r.doc_id, r.lang_pred) for r in language.predict_language(odd_docs, trees).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (10, "und"), (None, "und"), (6, "fr"), (9, "en")} <= got
    none = language.learn_trees(no_docs)
    assert {r.lang_pred for r in language.predict_language(odd_docs, none).collect()} == {"und"}
    assert language.predict_language(no_docs, trees).count() == 0


def test_code_lengths_are_of_a_distribution():
    rows = [("a", gram, n) for gram, n in {b"x": 3, b"y": 1, b"xy": 1, b"xx": 2}.items()]
    trees = language.ContextTrees(rows, 2)
    for context in (b"", b"x", b"z"):
        total = sum(2 ** -trees._bits(trees.trees[0], context + bytes([s])) for s in range(256))
        assert total == pytest.approx(1)


def test_warc(spark):
    pages = [
        (3, "http://a/", "same"), (1, None, "same"), (2, "http://b/\r\nX: y", ""), (4, "u", None), (None, "n", "same"),
        (5, "http://c/", "é" * 200_000), (1, None, "same"), (6, "d", "WARC/1.1\r\n\r\n\r\n"), (None, "only", "alone"),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    place = warc.new_folder(spark)
    warc.write_archives(frame, place)
    chunks = warc.read_chunks(spark, place)
    got = sorted(((r.page_id or 0), r.payload_bytes, r.record_type, r.refers_to) for r in warc.page_records(chunks).collect())
    assert got == [
        (0, 4, "revisit", 1), (0, 5, "response", None), (1, 4, "response", None), (1, 4, "response", None), (2, 0, "response", None),
        (3, 4, "revisit", 1), (4, 0, "revisit", 2), (5, 400_000, "response", None), (6, 14, "response", None),
    ]
    assert chunks.filter("page_id = 5").count() == -(-400_000 // warc.CHUNK_BYTES)
    assert chunks.filter("record_type = 'response' AND is_last AND declared_digest <> digest_so_far").count() == 0
    whole = {bytes(r.payload) for r in warc.payloads(chunks, 100).collect()}
    assert ("é" * 200_000).encode() in whole and b"WARC/1.1\r\n\r\n\r\n" in whole
    place = warc.new_folder(spark)
    warc.write_archives(frame, place, least_bytes=5)
    assert warc.page_records(warc.read_chunks(spark, place)).filter("record_type = 'revisit'").count() == 0
    place = warc.new_folder(spark)
    warc.write_archives(frame.limit(0), place)
    assert warc.read_chunks(spark, place).count() == 0


def test_html(spark):
    page = (
        "<html><head><title>T</title></head><body><nav><a href='/'>Home</a></nav><article><h1>Head &amp; line</h1>"
        "<p>First  paragraph of the article, long enough to be one.<p>Second &lt;one&gt; of it, also long enough."
        "<script>var t='</p>';</script></article><footer>&copy; x</footer>"
    )
    pages = [(1, page), (2, None), (3, ""), (4, "<"), (5, "<p>" * 3000), (1, page), (6, page + "<div>" * 500 + "z" * 200_000)]
    frame = spark.createDataFrame(pages, "page_id long, html string").withColumn("text", F.lit("mine"))
    model = html_extraction.learn_chain(frame)
    got = {r.page_id: r.main_text for r in html_extraction.extract_text(frame, model).collect()}
    assert got[1] == (
        "Head & line\nFirst paragraph of the article, long enough to be one.\nSecond <one> of it, also long enough."
    )
    assert got[2] == got[3] == got[5] == ""
    assert html_extraction.extract_text(frame.limit(0), model).count() == 0


@pytest.mark.parametrize(
    "part",
    [
        "<svg viewBox='0 0 1 1'/>", "<svg-icon></svg-icon>", "<button-group></button-group>", "<title-bar></title-bar>",
        "<datalist><option>x<option>y</datalist>", "<select><optgroup><option>x</optgroup><option>y</select>",
        "<div><button>x</div>", "<span><button>x</span>", "<div><button>x<button>y</button></div>",
        "<div><noscript><p>x</div>", "<div><object><div>x</div></div>", "<ul><li><template><b>x</ul>", "<a><svg><path></a>",
        "<svg><style>a</svg>", "<svg><title>x</title><path d=''/><g></svg>", "<svg><path>", "<script>x</script type='a'>",
        "<noscript><div>x</div>x</noscript>", "<template><div>x</div><p>x</template>",
    ],
)
def test_html_skips_no_more_than_the_element(part):
    page = f"<body><p>before</p>{part}<p>after <i>it</i></p><div>last</div></body>"
    assert [b.text for b in html_blocks.blocks(page)] == ["before", "after it", "last"]


def test_html_skipped_elements_leave_text_whole():
    page = "<p>one <a>two</a><button><p>x</p></button><svg><g/></svg> three<select><option>x</select>four</p><textarea>x<p>y"
    assert html_blocks.blocks(page) == [("one two three four", {"t:p"}, "p", 3)]


def test_html_attribute_values_of_any_length():
    value = "<p>x</p>" * 2000
    page = f"""<article data-x='{value}' class="story"><p title = "{value}">text</p><a href=/?a="b>link</a></article><p alt="x>end"""
    got = html_blocks.blocks(page)
    assert [b.text for b in got] == ["text", "link", "end"] and all("n:story" in b.above for b in got[:2])
    assert [b.text for b in html_blocks.blocks("<p title='5' tall'>it's <b>5'</b></p><p>more</p>")] == ["it's 5'", "more"]
    assert html_blocks.blocks("<p x=\"'>" * 100_000) == []


def test_html_sees_all_names_of_an_element():
    names = " ".join(f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}-1/4" for i in range(100))
    model = html_extraction.ChainModel({"": 1.0, "n:sidebar": -2.0}, [[0.0, 0.0], [0.0, 0.0]])
    page = f"<div class='{names}'><p>taken</p></div><div class='{names} sidebar' id=x><p>left out</p></div>"
    assert model.extract(page) == "taken"


def test_html_learns_from_pages_that_mark_their_article(spark, monkeypatch):
    plain, marked = "<div><p>plain</p></div><!-- <article> -->", "<article><p>marked</p></article>"
    rows = [(i, marked if i % 50 == 7 else plain) for i in range(400)]
    frame = spark.createDataFrame([*rows, (None, marked), (5, None)], "page_id long, html string")
    monkeypatch.setattr(html_extraction, "training_pages", list)
    monkeypatch.setattr(html_extraction, "train_chain", list)
    assert html_extraction.learn_chain(frame, sample=5) == [marked] * 5
    assert html_extraction.learn_chain(frame, sample=20) == [marked] * 8 + [plain] * 12


def test_minhash_in_a_group_of_uneven_copies(spark, monkeypatch):
    """Copies with few to many edits: similarities on both sides of the threshold, several components."""
    monkeypatch.setattr(minhash, "BLOCK", 40)  # so that the group takes several tasks
    random = np.random.default_rng(5)
    texts = []
    for base in range(3):
        words = [f"w{base}x{i}" for i in range(150)]
        for _ in range(100):
            copy = list(words)
            for at in random.integers(0, 150, random.integers(0, 14)):
                copy[at] = f"e{random.integers(1 << 30)}"
            texts.append(" ".join(copy))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(146)} for t in texts]
    lowest = list(range(len(texts)))
    links = [
        (a, b)
        for a in range(len(texts))
        for b in range(a)
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    for _ in texts:
        for a, b in links:
            lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame).collect()}
    assert got == dict(enumerate(lowest))
    assert 3 < len(set(lowest)) < 250
