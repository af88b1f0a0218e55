"""Search against a plain Python count over a small hand-made collection."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from grantlens.operators import search as S
from grantlens.sources import index_store, title_store

DOCS = {
    "1": ("Quantum computing", "A computer that computes with qubits. Computing is quick."),
    "2": ("Neural network", "Networks of neurons learn; the network computes."),
    "3": ("Gene editing", "CRISPR edits a gene and THE genes."),
    "4": ("‘Keynote’ reader", "keynote été Été"),
    "5": ("Quantum gene", "quantum network gene the the the"),
    "6": (None, None),
    "7": ("Empty abstract", None),
}
TOKEN = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def words(text):
    folded = "".join(c.lower() if c.isascii() else c for c in text or "")
    return TOKEN.findall(folded)


BAGS = {k: Counter(words(t) + words(a)) for k, (t, a) in DOCS.items()}
N = len(BAGS)
AVERAGE = sum(sum(b.values()) for b in BAGS.values()) / N


def score(doc, terms):
    total = 0.0
    for term in terms:
        tf, df = BAGS[doc][term], sum(term in b for b in BAGS.values())
        if tf:
            idf = max(math.log((N - df + 0.5) / (df + 0.5)), 1e-6)
            length = sum(BAGS[doc].values())
            total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / AVERAGE))
    return round(total, 6)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [(k, *v) for k, v in DOCS.items()], "patent_id string, title string, abstract string"
    )


@pytest.fixture(scope="module")
def index(docs):
    return S.scan_index(docs)


CASES = [
    ("quantum", lambda b: b["quantum"], ["quantum"]),
    ("quantum gene", lambda b: b["quantum"] and b["gene"], ["quantum", "gene"]),
    ("Quantum, GENE!", lambda b: b["quantum"] and b["gene"], ["quantum", "gene"]),
    ("the the", lambda b: b["the"], ["the", "the"]),
    ("gene OR network", lambda b: b["gene"] or b["network"], ["gene", "network"]),
    (
        "quantum network OR gene",  # a word of an alternative that does not hold does not count
        lambda b: (b["quantum"] and b["network"]) or b["gene"],
        lambda b: ["quantum", "network"] * bool(b["quantum"] and b["network"]) + ["gene"],
    ),
    ("gene or network", lambda b: b["gene"] and b["or"] and b["network"], []),
    ("quantum NOT gene", lambda b: b["quantum"] and not b["gene"], ["quantum"]),
    (
        "gene the NOT crispr edits",
        lambda b: b["gene"] and b["the"] and not (b["crispr"] and b["edits"]),
        ["gene", "the"],
    ),
    (
        "quantum AND gene NOT crispr OR neural",
        lambda b: (b["quantum"] and b["gene"] and not b["crispr"]) or b["neural"],
        lambda b: ["quantum", "gene"] * bool(b["quantum"] and b["gene"] and not b["crispr"]) + ["neural"],
    ),
    ("keynote", lambda b: b["keynote"], ["keynote"]),
    ("été", lambda b: b["été"], ["été"]),
    ("q", lambda b: False, []),  # too short
    ("?!", lambda b: False, []),
    ("gene OR", lambda b: False, []),  # malformed
]


def test_search_equals_plain_count(spark, index):
    queries = S.as_queries(spark, [text for text, _, _ in CASES])
    found = {}
    for row in S.search(index, queries).collect():
        found.setdefault(row.query_id, {})[row.patent_id] = row.score
    for number, (text, holds, terms) in enumerate(CASES):
        scored = terms if callable(terms) else lambda bag, fixed=terms: fixed
        wanted = {d: score(d, scored(bag)) for d, bag in BAGS.items() if holds(bag)}
        assert found.get(number, {}) == pytest.approx(wanted), text


PHRASES = [
    ("quantum_gene", [["quantum gene"]]),
    ("quantum_computing a", [["quantum computing", "a"]]),
    ("gene_quantum", [["gene quantum"]]),  # title and abstract are apart: no phrase runs from one into the other
    ("the_the", [["the the"]]),  # two of them in three words
    ("the_the_the OR the_network", [["the the the"], ["the network"]]),
    ("Edits_A_gene the", [["edits a gene", "the"]]),
    ("networks_of_neurons network", [["networks of neurons", "network"]]),
    ("_gene_ __", [["gene"]]),
    ("été_été", [["été été"]]),
]


def phrase_count(doc, phrase):
    wanted = phrase.split(" ")
    fields = [words(text) for text in DOCS[doc]]
    return sum(f[i : i + len(wanted)] == wanted for f in fields for i in range(len(f)))


def phrase_scores(alternatives):
    """Phrases and words alike count as terms, with their own number of documents."""
    found = {}
    for terms in alternatives:
        df = {t: sum(phrase_count(d, t) > 0 for d in DOCS) for t in terms}
        for doc, bag in BAGS.items():
            tf = {t: phrase_count(doc, t) for t in terms}
            if all(tf.values()):
                norm = 1.2 * (0.25 + 0.75 * sum(bag.values()) / AVERAGE)
                idf = {t: max(math.log((N - df[t] + 0.5) / (df[t] + 0.5)), 1e-6) for t in terms}
                found[doc] = found.get(doc, 0) + sum(idf[t] * n * 2.2 / (n + norm) for t, n in tf.items())
    return {d: round(x, 6) for d, x in found.items()}


@pytest.mark.parametrize("stored", [False, True])
def test_phrases_equal_plain_count(spark, docs, index, tmp_path, stored):
    if stored:
        index_store.write_index(S.build_index(docs), str(tmp_path), buckets=8, slots=4)
        index = index_store.read_index(spark, str(tmp_path))
    found = {}
    for row in S.search(index, S.as_queries(spark, [text for text, _ in PHRASES])).collect():
        found.setdefault(row.query_id, {})[row.patent_id] = row.score
    for number, (text, alternatives) in enumerate(PHRASES):
        assert found.get(number, {}) == pytest.approx(phrase_scores(alternatives)), text


def test_phrases_of_stems(spark, docs):
    index = S.build_index(docs, stem=True)
    found = S.search(index, S.as_queries(spark, ["networking_of_neuron", "edit_a_genes", "gene_edits"])).collect()
    assert sorted((r.query_id, r.patent_id) for r in found) == [(0, "2"), (1, "3"), (2, "3")]


def test_limit_takes_the_best(spark, index):
    queries = S.as_queries(spark, ["the OR gene OR network"])
    everything = S.search(index, queries).collect()
    order = [r.patent_id for r in sorted(everything, key=lambda r: (-r.score, r.patent_id))]
    assert len(order) > 2
    assert {r.patent_id for r in S.search(index, queries, 2).collect()} == set(order[:2])


def test_malformed_queries(spark):
    texts = ["OR", "a b", "x AND", "NOT y", "x OR OR y", "x NOT AND y", "x AND y NOT z"]
    found = S.malformed_queries(S.as_queries(spark, texts)).collect()
    assert sorted(r.query_id for r in found) == [0, 2, 3, 4, 5]


def test_stems_unite_words(spark, docs):
    index = S.build_index(docs, stem=True)
    found = S.search(index, S.as_queries(spark, ["computers", "networking gene"])).collect()
    assert sorted((r.query_id, r.patent_id) for r in found) == [(0, "1"), (0, "2"), (1, "5")]


def test_unicode_tokenizer(spark, docs):
    index = S.build_index(docs, tokenizer="unicode")
    (row,) = S.search(index, S.as_queries(spark, ["keynote"])).collect()
    assert row.patent_id == "4"
    assert {r.term: r.n_hits for r in index.terms.collect()}["keynote"] == 2


@pytest.mark.parametrize("stem", [False, True])
def test_stored_index_answers_alike_and_prunes(spark, docs, rows, tmp_path, stem):
    built = S.build_index(docs, stem=stem)
    index_store.write_index(built, str(tmp_path), buckets=16)
    stored = index_store.read_index(spark, str(tmp_path))
    assert (stored.stemmed, stored.buckets) == (stem, 16)
    queries = S.as_queries(spark, ["quantum gene", "the OR network"])
    assert rows(S.search(stored, queries)) == rows(S.search(built, queries)) != []
    found = S._matches(stored, S._weighted(stored.terms, S.query_terms(queries, stem), stored))
    plan = found._jdf.queryExecution().executedPlan().toString().lower()
    assert "dynamicpruning" in plan
    assert "hashpartitioning(term" not in plan.split("subquery")[0].split("broadcastexchange")[0]
    assert "abstract" not in plan


def test_pruned_search_finds_the_same_and_reads_less(spark, tables, rows):
    """Over the documents of the test tables: the best few, with ties, for words that half of the documents have."""
    texts = ["the", "the and", "the OR que", "of the NOT que", "worthless then", "que la", "the of and AND to"]
    queries = S.as_queries(spark, texts)
    built = S.build_index(tables.search_docs)
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/pruned"
    index_store.write_index(built, folder, buckets=8, slots=4)
    stored = index_store.read_index(spark, folder)
    full = S._matches(stored, S._weighted(stored.terms, S.query_terms(queries), stored)).persist()
    for k in (1, 5):
        assert rows(S.search(stored, queries, k, prune=True)) == rows(S._best(full, k)) != []
    # Few documents to a band: here little can be left out. README has the share over more of them.
    read = {r.query_id: (r.n_read, r.n) for r in S.postings_read(stored, queries, 1).collect()}
    assert all(a <= b for a, b in read.values()) and sum(a for a, _ in read.values()) < sum(b for _, b in read.values())


def changes_of(spark):
    return spark.createDataFrame(
        [
            ("1", 1, False, "Quantum", "first revision"),
            ("1", 2, False, "Quantum", "second revision of gene"),
            ("3", 1, True, None, None),
            ("99", 1, True, None, None),  # never was there
            ("8", 1, False, "New", "brand new network"),
            ("9", 1, False, "Gone", "at once"),
            ("9", 2, True, None, None),
        ],
        "patent_id string, seq bigint, is_delete boolean, title string, abstract string",
    )


def final_docs(spark):
    final = {k: v for k, v in DOCS.items() if k != "3"}
    final |= {"1": ("Quantum", "second revision of gene"), "8": ("New", "brand new network")}
    return spark.createDataFrame(
        [(k, *v) for k, v in final.items()], "patent_id string, title string, abstract string"
    )


def tables_of(index, rows):
    return [
        rows(index.postings.select("term", "patent_id", "tf", "doc_len")),
        rows(index.documents.select("patent_id", "doc_len")),
        rows(index.terms.select("term", "n_docs", "n_hits")),
        rows(index.corpus.select("n_docs", "n_tokens")),
    ]


@pytest.mark.parametrize("stem", [False, True])
def test_maintained_equals_rebuilt(spark, docs, rows, tmp_path, stem):
    folder = str(tmp_path)
    index_store.write_index(S.build_index(docs, stem=stem), folder, buckets=8)
    rebuilt = rows(S.index_rows(S.build_index(final_docs(spark), stem=stem)))
    for _ in range(2):  # the same segment again changes nothing
        index_store.apply_changes(changes_of(spark), folder, 1)
        assert rows(S.index_rows(index_store.read_index(spark, folder))) == rebuilt
    late = changes_of(spark).filter("seq = 1").withColumn("is_delete", F.lit(True))
    index_store.apply_changes(late.filter("patent_id IN ('1', '3', '9')"), folder, 2)
    assert rows(S.index_rows(index_store.read_index(spark, folder))) == rebuilt
    queries = S.as_queries(spark, ["quantum gene", "network", "revision", "second_revision OR brand_new_network"])
    found = rows(S.search(index_store.read_index(spark, folder), queries))
    assert found == rows(S.search(S.build_index(final_docs(spark), stem=stem), queries)) != []
    index_store.merge(spark, folder, f"{folder}-merged")
    merged = index_store.read_index(spark, f"{folder}-merged")
    assert rows(S.index_rows(merged)) == rebuilt
    assert index_store.segments_of(spark, f"{folder}-merged") == [0]
    index_store.apply_changes(late.filter("patent_id = '9'").withColumn("is_delete", F.lit(False)), f"{folder}-merged", 1)
    assert rows(S.index_rows(index_store.read_index(spark, f"{folder}-merged"))) == rebuilt


def test_fallback_title(spark):
    patents = spark.createDataFrame(
        [("1", "50% Faster OR", 2001), ("2", "faster or not", 2003), ("3", "50 and 60 faster", None)],
        "patent_id string, title string, year int",
    )

    def found(texts, **options):
        return S.fallback_title(S.scan_titles(patents), S.as_queries(spark, texts), **options).collect()

    assert sorted((r.query_id, r.patent_id) for r in found(["OR", "50%", "x", "OR"])) == [
        (0, "1"), (0, "2"), (1, "1"), (3, "1"), (3, "2"),
    ]
    assert sorted((r.query_id, r.patent_id) for r in found(["OR", "OR"], k=1)) == [(0, "2"), (1, "2")]
    assert [r.patent_id for r in found(["50%60"], wildcards=True)] == ["3"]


def test_search_or_title(spark, docs, index):
    patents = docs.withColumn("year", F.lit(2000))
    titles = S.scan_titles(patents)
    queries = S.as_queries(spark, ["gene", "gene OR", "quantum comp", "NOT"])
    found = S.search_or_title(index, titles, queries).collect()
    kinds = {(r.query_id, r.found_by, r.score is None) for r in found}
    assert kinds == {(0, "text", False), (3, "title", True)}  # of "Keynote"
    titled = S.search_or_title(index, S.scan_titles(patents.withColumn("title", F.lit("Gene OR not"))), queries).collect()
    assert {(r.query_id, r.found_by) for r in titled} == {(0, "text"), (1, "title"), (3, "title")}


def test_first_abstracts(spark, docs, index):
    hits = S.search(index, S.as_queries(spark, ["the OR gene OR network"]))
    listed = S.first_abstracts(S.with_facts(hits, docs), 1).collect()
    assert len(listed) == 1 and listed[0].abstract == DOCS[listed[0].patent_id][1]


TITLES = ["The the", "th", "t", "", None, "50% of it", "a_b c", "ABC abc", "İstanbul", "x", "the quick ab", "bab", "%", "__", "aab aab", "été É"]
TITLE_TEXTS = ["the", "TH", "ab", " t", "50%", "a_b", "bc a", "it", "zz", "été", "é é", "%", "aab aa", "  ", "the quick ab", "i̇s"]


@pytest.mark.parametrize("stored", [False, True])
@pytest.mark.parametrize("wildcards", [False, True])
def test_titles_equal_a_scan(spark, tmp_path, stored, wildcards):
    patents = spark.createDataFrame(
        [(str(i), t, 2000 + i % 3, "x") for i, t in enumerate(TITLES)], "patent_id string, title string, year int, gram string"
    )
    titles = S.scan_titles(patents)
    if stored:
        title_store.write_titles(patents, str(tmp_path), buckets=4)
        titles = title_store.read_titles(spark, str(tmp_path))
    texts = TITLE_TEXTS + (["a%c", "_h", "%%", "t%q__ck", "a__b", "_%_", "e_"] if wildcards else [])
    found = S.fallback_title(titles, S.as_queries(spark, texts), wildcards=wildcards)
    assert found.columns == [*patents.columns, "query_id"]

    def holds(title, text):
        if title is None or len(text.strip(" ")) < 2:
            return False
        if not wildcards:
            return text.lower() in title.lower()
        pattern = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in text.lower())
        return bool(re.fullmatch(f".*{pattern}.*", title.lower(), re.DOTALL))

    wanted = {(q, str(i)) for q, text in enumerate(texts) for i, t in enumerate(TITLES) if holds(t, text)}
    assert {(r.query_id, r.patent_id) for r in found.collect()} == wanted
    plan = found._jdf.queryExecution().executedPlan().toString().lower()
    assert "collect_list" not in plan and "cartesian" not in plan and "nestedloop" not in plan
    assert not stored or "dynamicpruning" in plan


def test_large_query_tables_are_not_broadcast(spark):
    from grantlens.functions import joins

    frame = spark.range(100).withColumn("term", F.lit("word"))
    hinted = lambda f: "hint" in f._jdf.queryExecution().logical().toString().lower()
    assert hinted(joins.if_small(frame)) and not hinted(joins.if_small(frame, most_bytes=100))
