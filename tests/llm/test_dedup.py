"""Near-duplicates and substring dedup against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from demandspark.llm.components import components
from demandspark.llm.near_dedup import near_duplicates
from demandspark.llm.substring_dedup import WINDOW, cleaned_documents, kept_words

from tests.llm.data import both, edge_docs, words


def shingles(text):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[i:i + 5]) for i in range(len(found) - 4)} or ({tuple(found)} if found else set())


def brute_components(rows):
    sets = [(doc, shingles(text)) for doc, text in rows]
    parent = {doc: doc for doc, _ in sets if doc is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    at = defaultdict(list)
    for i, (doc, own) in enumerate(sets):
        for s in own if doc is not None else ():
            at[s].append(i)
    for i, (doc, own) in enumerate(sets):
        for j, n in Counter(j for s in own if doc is not None for j in at[s] if j < i).items():
            if 100 * n >= 85 * (len(own) + len(sets[j][1]) - n):
                a, b = sorted((find(doc), find(sets[j][0])))
                parent[b] = a
    return [(doc, len(own), None if doc is None else find(doc) if own else doc, doc is None or doc == (find(doc) if own else doc)) for doc, own in sets]


@pytest.mark.parametrize("which", [both, edge_docs])
def test_near_duplicates(spark, which):
    docs = which(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, near_duplicates(docs).collect()), key=str) == sorted(brute_components(rows), key=str)


def test_near_duplicates_of_a_family(spark):
    """Copies with ever more changes: links chain, and some members meet without a link."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for doc in range(150):
        text = list(base)
        for at in rng.sample(range(150), rng.randint(0, 6)):
            text[at] = f"x{rng.randint(0, 40)}"
        rows.append((doc, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, near_duplicates(docs).collect())) == sorted(brute_components(rows))


def test_near_duplicates_of_a_repeated_id_in_open_keys(spark):
    """Only the last comparisons can find 50 and 60 alike, and id 50 has a second text without a shared shingle."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = [(50, " ".join(base)), (50, " ".join(f"u{i}" for i in range(600))), (60, " ".join(base[:100] + ["x"] + base[101:]))]
    for doc in [*range(40), *range(100, 140)]:  # hubs below and above, none alike enough
        text = list(base)
        for at in rng.sample(range(5, 195, 10), 5):
            text[at] = f"y{doc}_{at}"
        rows.append((doc, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, near_duplicates(docs).collect()))
    assert got == sorted(brute_components(rows)) and {r[2] for r in got if r[0] in (50, 60)} == {50}
    more = rows + rows[:3] + [(60, "a b c d e f"), (39, rows[1][1])]
    assert sorted(map(tuple, near_duplicates(spark.createDataFrame(more, "doc_id long, text string")).collect())) == sorted(brute_components(more))


def test_rows_without_an_id_link_nothing(spark):
    """Three null-id rows that copy unrelated documents don't make these one."""
    rng = random.Random(6)
    a, b, c, d = (" ".join(f"{name}{rng.randint(0, 900)}" for _ in range(60)) for name in "abcd")
    rows = [(1, a), (2, b), (3, c), (4, a + " more"), (None, a), (None, b), (None, c), (None, d), (None, d), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, near_duplicates(docs).collect()), key=str)
    assert got == sorted(brute_components(rows), key=str)
    assert {r[0]: r[3] for r in got if r[0] is not None} == {1: True, 2: True, 3: True, 4: False}


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(edge_docs(spark).limit(0)).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(100, 101), (200, 200)], "a long, b long"))
    found = {r.v: r.c for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def brute_kept(rows):
    first = {}
    for doc, text in rows:
        found = words(text)
        for k in range(len(found) - WINDOW + 1):
            key = tuple(found[k:k + WINDOW])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        found = words(text)
        keep = [True] * len(found)
        for k in range(len(found) - WINDOW + 1):
            if doc is not None and first[tuple(found[k:k + WINDOW])] < doc:
                keep[k:k + WINDOW] = [False] * WINDOW
        left = " ".join(w for w, k in zip(found, keep, strict=True) if k)
        out.append((doc, len(found), keep.count(False), hashlib.sha256(left.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("which", [both, edge_docs])
def test_substring_dedup(spark, which):
    docs = which(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, kept_words(docs).collect()), key=str) == sorted(brute_kept(rows), key=str)


def test_substring_dedup_of_shifted_and_nested_passages(spark):
    rng = random.Random(2)
    passages = [[f"p{i}_{rng.randint(0, 3)}" for i in range(n)] for n in (13, 14, 40, 60)]
    rows = []
    for doc in range(60):
        text = []
        for _ in range(rng.randint(1, 4)):
            text += [f"u{rng.randint(0, 50)}" for _ in range(rng.randint(0, 8))]
            p = rng.choice(passages)
            a = rng.randint(0, max(0, len(p) - 10))
            text += p[a:a + rng.randint(8, 60)]
        rows.append((rng.randint(0, 40), " ".join(text)))  # ids repeat, with other texts
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, kept_words(docs).collect())) == sorted(brute_kept(rows))


def test_cleaned_documents_keep_their_columns(spark):
    docs = edge_docs(spark)
    clean = cleaned_documents(docs)
    assert clean.schema.names == docs.schema.names and clean.count() == docs.count()
    assert kept_words(docs.limit(0)).count() == cleaned_documents(docs.limit(0)).count() == 0
