"""Cross-tokenizer alignment against a brute-force version over the tokenizer files themselves."""
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from appraise.llm import token_alignment as ta
from conftest import SMALL


@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def byte_letters():
    """The letters that byte-level vocabularies use for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in plain]
    return {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(rest)}


def brute(texts, tokenizers):
    a, b = tokenizers
    letters = byte_letters()
    docs, pairs = [], Counter()
    for text in texts:
        tokens = []
        if text:
            whole = (" " + text).encode()
            ids_a = a.encode(" " + text, add_special_tokens=False).ids
            ids_b = b.encode(text)
            bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
            bytes_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
                       for p in map(b.id_to_piece, ids_b)]
            if b"".join(bytes_a) == whole == b"".join(bytes_b):
                tokens = [ids_a, ids_b, np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()]
        if not tokens:
            docs.append(None)
            continue
        ids_a, ids_b, end_a, end_b = tokens
        common = sorted(set(end_a) & set(end_b))
        groups, last = [], 0
        for c in common:
            groups.append(",".join(str(i) for i, e in zip(ids_a, end_a) if last < e <= c) + "|"
                          + ",".join(str(i) for i, e in zip(ids_b, end_b) if last < e <= c))
            last = c
        links = [(x, y) for k, x in enumerate(ids_a) for m, y in enumerate(ids_b)
                 if max(end_a[k - 1] if k else 0, end_b[m - 1] if m else 0) < min(end_a[k], end_b[m])]
        pairs.update(set(links))
        docs.append((len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = defaultdict(int)
    for (x, _), n in pairs.items():
        top[x] = max(top[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (d[0], d[1], d[2], len(d[3]), sum(pairs[p] == top[p[0]] for p in d[3]), sum(pairs[p] for p in d[3]), d[4]) for d in docs]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_runs_against_common_ends():
    rng = random.Random(3)
    for _ in range(400):
        n = rng.randrange(1, 80)
        density = rng.choice([.2, .9, .99])
        common = [n] if rng.random() < .5 else sorted({n, *rng.sample(range(1, n + 1), int(density * n))})
        a, b = (np.array(sorted({*common, *(x for x in range(1, n) if rng.random() < .2)})) for _ in range(2))
        found = ta.diagonal_runs(a, b)
        ends = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[found.last_a].tolist() == b[found.last_b].tolist() == ends and found.n_groups == len(ends)
        want = [(i, j) for i in range(len(a)) for j in range(len(b))
                if max(a[i - 1] if i else 0, b[j - 1] if j else 0) < min(a[i], b[j])]
        assert sorted(zip(found.link_a.tolist(), found.link_b.tolist())) == want


def test_documents(spark, tokenizers):
    """The query's operator on the shortest documents of the table (the brute force is quadratic)."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) < 1500 OR text IS NULL")
    rows = docs.select("doc_id", "text").collect()
    out = ta.align(docs, chunk_bytes=3000)
    assert out.columns == COLUMNS
    want = brute([r.text for r in rows], tokenizers)
    assert sorted(map(tuple, out.collect())) == sorted((r.doc_id, *w) for r, w in zip(rows, want))


def test_whole_query(spark, tokenizers):
    """Every row of the table; figures that need no quadratic search."""
    a, b = tokenizers
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = ta.op13_token_alignment(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    for r in got:
        if r.n_a:
            assert r.n_a == len(a.encode(" " + rows[r.doc_id], add_special_tokens=False).ids)
            assert r.n_b == len(b.encode(rows[r.doc_id]))
            assert r.n_links == r.n_a + r.n_b - r.n_groups and 0 <= r.n_best <= r.n_links <= r.count_sum


def test_edges(spark, tokenizers):
    rng = random.Random(9)
    alphabet = ["a", "the ", "  ", "\n", "é", "字", "😀", "▁", "<s>", "<|endoftext|>", "<0x41>", "\t", "\x00", "12", "</s>", "́"]
    texts = [None, "", " ", "   lead", "tail   ", "<unk>", "same words here", "same words here", "x▁y"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    rows = [(None if i % 7 == 0 else i // 2, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for name in ("chunk", "id", "codes", "held", "place", "value", "code", "sha", "steps"):
        df = df.withColumn(name, F.lit("other"))
    want = sorted(map(repr, ((i, *w) for (i, _), w in zip(rows, brute(texts, tokenizers)))))
    for size in (1, 200, 1 << 20):
        assert sorted(map(repr, map(tuple, ta.align(df, chunk_bytes=size).collect()))) == want
    shown = {r.doc_id: r.groups for r in ta.align(df.where("doc_id = 3"), shown=True).collect()}
    assert shown and all(isinstance(g, str) for g in shown.values())


def test_empty_and_long(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ta.align(empty).collect() == []
    long = "naïve words and Zahlen 12345 " * 40000
    r = ta.align(spark.createDataFrame([(1, long), (2, long)], "doc_id long, text string"), chunk_bytes=1000).collect()
    assert len(r) == 2 and r[0][1:] == r[1][1:] and r[0].n_links == r[0].n_a + r[0].n_b - r[0].n_groups
    assert r[0].count_sum == 2 * r[0].n_links
