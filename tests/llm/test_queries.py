"""The registered queries against their SQL, or against plain versions of their contracts."""

import base64
import collections
import hashlib
import zlib

import compare
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from grantlens.llm.queries import ORACLES, QUERIES, WORD_BPE

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return [r.asDict() for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()]


@pytest.fixture(scope="module")
def token_ids(docs):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    return {d["doc_id"]: tokenizer.encode(d["text"] or "", add_special_tokens=False).ids for d in docs}


def raw(ids):
    return np.array(ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), compare.duck(FOLDER), ORACLES[name]) is None


def lowest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_sets(docs):
    sets = {}
    for d in docs:
        words = (d["text"] or "").encode().lower().split()
        whole = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) > 4 else [tuple(words)] if words else []
        sets[d["doc_id"]] = set(whole)
    return sets


def shingle_links(sets):
    holders = collections.defaultdict(list)
    for doc, items in sets.items():
        common = collections.Counter(other for item in items for other in holders[item])
        for other, n in common.items():
            if 100 * n >= 75 * (len(items) + len(sets[other]) - n):
                yield doc, other
        for item in items:
            holders[item].append(doc)


def test_minhash_equals_brute_force(spark, docs):
    sets = shingle_sets(docs)
    lowest = lowest_reachable(sets, shingle_links(sets))
    got = QUERIES["op4_minhash"](spark, FOLDER).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {
        (d, len(sets[d]), lowest[d], d == lowest[d]) for d in sets
    }
    assert len(got) == len(docs)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.1"])
def test_rotation_codes_equal_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    matrix = np.array([r.embedding for r in rows])
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    near = matrix @ matrix.T >= 0.9
    np.fill_diagonal(near, False)
    ids = [r.vec_id for r in rows]
    lowest = lowest_reachable(ids, ((ids[a], ids[b]) for a, b in zip(*np.nonzero(near))))
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in QUERIES["op1_rotation_codes"](spark, folder).collect()}
    assert got == {(i, int(n), lowest[i], i == lowest[i]) for i, n in zip(ids, near.sum(axis=1))}


def test_graph_search_recall(spark):
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, matrix = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    got = collections.defaultdict(dict)
    for r in QUERIES["op7_graph_search"](spark, folder).collect():
        got[r.query_id][r["rank"]] = (r.vec_id, r.score)
    hits, asked = 0, [i for i in ids.tolist() if i % 50 == 0]
    assert sorted(got) == asked
    for query in asked:
        cosines = matrix @ matrix[ids == query][0]
        cosines[ids == query] = -2
        best = np.lexsort((ids, -cosines))[:5]
        hits += len({ids[b] for b in best} & {v for v, _ in got[query].values()})
        assert sorted(got[query]) == [1, 2, 3, 4, 5]
        for vec, score in got[query].values():
            assert score == pytest.approx(cosines[ids == vec][0], abs=1e-12)
    assert hits >= 0.95 * 5 * len(asked)


def test_warc_equals_brute_force(spark):
    first, expected = {}, set()
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").orderBy("page_id").collect():
        payload = (r.html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kept = first.setdefault(digest, r.page_id)
        kind = ("response", None) if kept == r.page_id else ("revisit", kept)
        expected.add((r.page_id, len(payload), digest, *kind))
    got = QUERIES["op2_warc"](spark, FOLDER)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert {tuple(r) for r in got.select(*columns).collect()} == expected


def test_packing_is_a_round_trip(spark, token_ids):
    pieces = collections.defaultdict(list)
    sequences = collections.defaultdict(list)
    for r in QUERIES["op3_packing"](spark, FOLDER).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(token_ids)
    for doc, found in pieces.items():
        ids, at = token_ids[doc] + [1], 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(raw(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == found[0].window and at & (at - 1) == 0 and at <= 2048


def test_token_shards_are_a_round_trip(spark, token_ids):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op8_token_shards"](spark, FOLDER).collect()}
    at = 0
    for doc in sorted(token_ids):
        ids = token_ids[doc] + [2]
        assert got.pop(doc) == (at, len(ids), zlib.crc32(raw(ids)))
        at += len(ids)
    assert not got


def test_language_of_held_out_documents(spark, docs):
    langs = {d["doc_id"]: d["lang"] for d in docs}
    got = QUERIES["op9_language"](spark, FOLDER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r.lang_pred == langs[r.doc_id] for r in got if r.held_out]
    assert sum(held) >= 0.98 * len(held) > 100


def test_extracted_text(spark):
    """Pages mark their article, so a plain cut is the expected text."""
    import html
    import re

    wrong = 0
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in QUERIES["op10_html_extraction"](spark, FOLDER).collect():
        article = re.search(r"<article>(.*?)(?:</article>|<footer|$)", pages[r.page_id], re.S)
        parts = re.split(r"</?(?:p|h1)\b[^>]*>", article[1]) if article else []
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
        wrong += r.text != "\n".join(x for x in lines if x)
        assert r.n_chars == len(r.text)
    assert wrong <= 0.02 * len(pages)


def test_pipeline_stages(spark, docs, token_ids):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sure = corpus_pipeline.identify_language(spark, frame, FOLDER)
    assert sure.columns == frame.columns
    assert {r.doc_id for r in sure.collect()} == {d["doc_id"] for d in docs if any(c.isalpha() for c in d["text"] or "")}
    single = corpus_pipeline.drop_near_duplicates(spark, sure, FOLDER)
    sets = shingle_sets([r.asDict() for r in sure.collect()])
    lowest = lowest_reachable(sets, shingle_links(sets))
    assert sorted(r.doc_id for r in single.collect()) == sorted({lowest[d] for d in sets})
    mixed = corpus_pipeline.mix_sources(spark, single, FOLDER)
    assert mixed.columns == frame.columns
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    assert set(copies.values()) <= {1, 2}
    pieces = corpus_pipeline.pack_sequences(spark, mixed, FOLDER).collect()
    lengths = collections.Counter()
    for r in pieces:
        lengths[r.doc_id] += r.length
    assert lengths == {d: n * (len(token_ids[d]) + 1) for d, n in copies.items()}
    assert len(corpus_pipeline.run(spark, FOLDER).columns) == len(pieces[0])
