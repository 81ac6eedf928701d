"""Alignment of two tokenizers against the libraries and a plain loop."""

import collections
import hashlib

import pytest

from spendstar.llm import alignment, bpe, queries
from tests.conftest import SF001


@pytest.fixture(scope="module")
def paths():
    return bpe.default_path("byte_bpe_50k.json"), bpe.default_path("piece_bpe_32k.model")


def plain(paths, texts):
    """(ids A, ids B, groups, links) of each text, from the libraries and byte ranges."""
    import sentencepiece

    tok = bpe.load(paths[0])
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    chars = alignment._byte_of_char()
    out = []
    for text in texts:
        if not text:
            out.append(([], [], [], []))
            continue
        a, b = tok.encode(" " + text, add_special_tokens=False), sp.encode(text)
        data_a = [bytes(chars[c] for c in t) for t in a.tokens]
        data_b = [
            bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in zip(b, map(sp.id_to_piece, b), strict=True)
        ]
        a = a.ids
        if not b"".join(data_a) == b"".join(data_b) == (" " + text).encode():
            out.append(([], [], [], []))
            continue
        ends = [[sum(map(len, d[: k + 1])) for k in range(len(d))] if len(d) < 400 else None for d in (data_a, data_b)]
        for side, d in enumerate((data_a, data_b)):
            if ends[side] is None:
                at, ends[side] = 0, []
                for x in d:
                    at += len(x)
                    ends[side].append(at)
        links, j = [], 0
        for x, d, e in zip(a, data_a, ends[0], strict=True):
            while ends[1][j] <= e - len(d):
                j += 1
            k = j
            while k < len(b) and ends[1][k] - len(data_b[k]) < e:
                links.append((x, b[k]))
                k += 1
        groups, ia, ib = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            ja, jb = ends[0].index(e, ia) + 1, ends[1].index(e, ib) + 1
            groups.append(f"{','.join(map(str, a[ia:ja]))}|{','.join(map(str, b[ib:jb]))}")
            ia, ib = ja, jb
        out.append((a, b, groups, links))
    return out


def expected(paths, rows):
    found = plain(paths, [t for _, t in rows])
    counts = collections.Counter(x for *_, links in found for x in links)
    best: dict = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (i, len(a), len(b), len(g), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), ";".join(g))
        for (i, _), (a, b, g, links) in zip(rows, found, strict=True)
    ]


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def aligned_rows(docs, paths, held):
    aligned = alignment.align(docs, *paths)
    out = alignment.with_rare_links(alignment.linked(aligned, held), aligned)
    return sorted(((tuple(r[c] for c in COLUMNS)) for r in out.collect()), key=str)


TRICKY = [
    (20, "a<|endoftext|>b and </s><s> <unk>"),
    (21, " leading and trailing "),
    (22, "tabs\tand\n\nline breaks\nin it.\n"),
    (23, "it's we're  two   blanks"),
    (24, "▁escaped▁mark"),
    (25, "日本語のテキスト と 😀😀 é"),
    (26, "word.\n'next,  no-break line"),
    (27, "x"),
    (28, " "),
    (29, "a \n b"),
    (30, "stop. Stop, stop.\nStop! ½ Ⅷ"),
]


@pytest.mark.parametrize("held", [alignment.HELD_PAIRS, 5, 0])
def test_equals_libraries(spark, edge, paths, held):
    docs = edge.select("doc_id", "text").union(spark.createDataFrame(TRICKY, "doc_id long, text string"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert aligned_rows(docs, paths, held) == sorted(expected(paths, rows), key=str)


def test_query_on_documents(spark, paths):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    want = [
        (*x[:7], hashlib.sha256(x[7].encode()).hexdigest() if x[1] else "") for x in expected(paths, rows)
    ]
    got = queries.op13_alignment(spark, SF001)
    names = [*COLUMNS[:7], "groups_sha256"]
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(want)


def test_small_caches_change_nothing(paths, monkeypatch):
    tool = alignment.Aligner(*paths)
    texts = [t for _, t in TRICKY] * 2
    windows = lambda: [[w for w in map(list(tool.window).__getitem__, found)] for found in tool.encode(texts)]
    first = windows()
    tool.empty()
    assert windows() == first


def test_empty_and_clashing(spark, empty, clashing, edge, paths):
    assert aligned_rows(empty, paths, 10) == []
    assert aligned_rows(clashing, paths, 10) == aligned_rows(edge, paths, 10)
    only = spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string")
    assert aligned_rows(only, paths, 10) == [(None, 0, 0, 0, 0, 0, 0, "")] * 2


def test_no_shuffle_of_texts(spark, paths):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    plan = alignment.linked(alignment.align(docs, *paths))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
