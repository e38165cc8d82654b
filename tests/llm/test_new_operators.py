"""Jaccard join, Merkle manifest and token alignment against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tabula.llm import alignment, jaccard, merkle
from tabula.llm.common import join_counted
from tests.conftest import SF_SMALL

public_tokenizers = pytest.importorskip("public_tokenizers")
A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def near_copies(seed=3, families=6, size=9):
    """Families of edited copies of unequal likeness, texts built from shared passages, short and equal ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passages = [[word() for _ in range(30)] for _ in range(6)]
    texts = []
    for _ in range(families):
        base = [word() for _ in range(rng.randint(8, 120))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = word().upper()
            texts.append(" ".join(w))
    texts += [" ".join(sum((passages[i] for i in rng.sample(range(6), 5)), [])) for _ in range(25)]
    return texts + [texts[0]] * 5 + ["a b c", "A b  c", "a b", "", None, "   \t"]


# Jaccard join

def plain_links(texts, width=5, percent=80):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(b" ".join(w[i:i + width]) for i in range(max(len(w) - width + 1, 1))) if w else frozenset()
    sets = [shingles(t) for _, t in texts]
    links = [[j for j, y in enumerate(sets) if j != i and x and y and 100 * len(x & y) >= percent * len(x | y)] for i, x in enumerate(sets)]
    out = []
    for i in range(len(sets)):
        seen, stack = {i}, [i]
        while stack:
            new = set(links[stack.pop()]) - seen
            seen |= new
            stack += new
        ids = [texts[j][0] for j in seen if texts[j][0] is not None]
        out.append((texts[i][0], len(sets[i]), min(ids, default=None), len(links[i])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [jaccard.BLOCK, 200])
def test_jaccard_join_against_all_pairs(spark, block):
    docs = spark.createDataFrame(list(enumerate(near_copies())), "doc_id long, text string")
    got = rows(jaccard.linked_documents(docs, block=block))
    assert got == plain_links(texts_of(docs))
    assert sum(r[3] > 0 for r in got) > 20


def test_jaccard_join_on_edge_cases(spark, edge_docs, no_docs):
    assert rows(jaccard.op11(edge_docs)) == plain_links(texts_of(edge_docs))
    assert jaccard.op11(no_docs).collect() == []


def test_search_finds_every_linked_set_before_a_set():
    rng = np.random.default_rng(5)
    for percent in (50, 80):
        base = [rng.choice(400, 40, replace=False) for _ in range(6)]
        sets = [np.unique(np.concatenate([b[rng.random(40) < 0.92], rng.choice(400, 3)])).astype(np.uint64) for b in base for _ in range(15)]
        sets.sort(key=len)
        index = jaccard.Index(sets, percent)
        for x, s in enumerate(sets):
            want = [y for y in range(x) if 100 * np.intersect1d(s, sets[y]).size >= percent * np.union1d(s, sets[y]).size]
            assert sorted(index.search(x).tolist()) == want


def test_both_merges_agree(monkeypatch):
    rng = np.random.default_rng(6)
    lists = [np.unique(rng.integers(0, 50, 20)) for _ in range(9)]
    heap = jaccard.merge(lists)
    monkeypatch.setattr(jaccard, "MERGE", 0)
    for a, b in zip(heap, jaccard.merge(lists)):
        assert a.tolist() == b.tolist()


def test_join_with_a_hot_key(spark):
    left = spark.createDataFrame([(1, i) for i in range(300)] + [(k, k) for k in range(2, 60)], "k long, v long")
    right = spark.createDataFrame([(1, 300)] + [(k, 1) for k in range(2, 40)], "k long, n long")
    assert rows(join_counted(left, right, "k", "n", 10)) == rows(left.join(right, "k"))


# Merkle manifest

def plain_manifest(docs):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"

    def digest(r, text):
        return sha("".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars, text))))

    def proofs(nodes):
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, i in enumerate(at):
                run = i // 8 * 8
                paths[k].append((nodes[run:i], nodes[i + 1:run + 8]))
            nodes = [sha("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
            at = [i // 8 for i in at]
        return nodes[0], paths
    groups = {}
    for r in docs:
        text = r.text
        if text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
            text = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
        groups.setdefault(r.lang, []).append(((r.doc_id is not None, r.doc_id or 0, digest(r, r.text)), r.doc_id, digest(r, r.text), digest(r, text)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [(sorted(groups[g]), *proofs([x[2] for x in sorted(groups[g])])) for g in order]
    root, upper = proofs([t[1] for t in trees])
    out = []
    for (leaves, subroot, paths), above in zip(trees, upper):
        for (_, doc, leaf, claimed), path in zip(leaves, paths):
            node = claimed
            for before, after in path + above:
                node = sha("".join(before) + node + "".join(after))
            out.append((doc, leaf, subroot, root, sha("".join("".join(b + a) for b, a in path + above)), node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 8, 9, 65, 600])
def test_manifest_against_a_plain_tree(spark, n):
    data = [(i, f"Text {i}", ["en", "de", None, "é"][i % 4] if n != 600 else "en", "s", i) for i in range(n)]
    docs = spark.createDataFrame(data, SCHEMA)
    assert rows(merkle.op12(docs)) == plain_manifest(docs.collect())


def test_manifest_on_edge_cases(spark, edge_docs, no_docs):
    got = rows(merkle.op12(edge_docs))
    assert got == plain_manifest(edge_docs.collect())
    assert merkle.op12(no_docs).collect() == []


def test_manifest_detects_changes_and_many_groups(spark):
    docs = spark.createDataFrame([(i, f"Upper {i}", f"l{i % 70}", None, None) for i in range(140)], SCHEMA)
    got = rows(merkle.op12(docs))
    assert got == plain_manifest(docs.collect())
    assert {r[0] for r in got if not r[-1]} == {i for i in range(140) if zlib.crc32(str(i).encode()) % 3 == 0}


# Token alignment

@pytest.fixture(scope="module")
def tokenizers_pair():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    names = {i: t for t, i in a.get_vocab().items()}
    alphabet = alignment.byte_alphabet()
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)

    def piece(i):
        p = b.id_to_piece(i)
        m = re.fullmatch("<0x([0-9A-F]{2})>", p)
        return bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode()

    def tokens(text):
        """(ids, bytes) of A and B over the whole text at once."""
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        return ia, [bytes(alphabet[c] for c in names[i]) for i in ia], ib, [piece(i) for i in ib]
    return tokens


def plain_alignment(tokens, text):
    """(a ids, b ids, groups, links) by the tokens' decoded bytes."""
    if not text:
        return [], [], [], []
    ia, ba, ib, bb = tokens(text)
    whole = (" " + text).encode()
    if b"".join(ba) != whole or b"".join(bb) != whole:
        return [], [], [], []
    owner_a, owner_b = ([k for k, x in enumerate(parts) for _ in x] for parts in (ba, bb))
    links = [(ia[x], ib[y]) for x, y in sorted(set(zip(owner_a, owner_b)))]
    cut_a, cut_b = ({int(e): k + 1 for k, e in enumerate(np.cumsum([len(x) for x in parts]))} for parts in (ba, bb))
    groups, x, y = [], 0, 0
    for end in sorted(cut_a.keys() & cut_b.keys()):
        groups.append((ia[x:cut_a[end]], ib[y:cut_b[end]], end))
        x, y = cut_a[end], cut_b[end]
    return ia, ib, groups, links


def plain_op13(tokens, texts):
    got = [(doc, *plain_alignment(tokens, t)) for doc, t in texts]
    count = Counter(x for g in got for x in g[4])
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for doc, a, b, groups, links in got:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y, _ in groups)
        out.append((doc, len(a), len(b), len(groups), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return sorted(out, key=repr)


ODD = ["Hi  <|endoftext|> naïve 😀 中\n\n x\t <0x41> <s> 𝕏𝕐 ﷽ ", "▁ a", "  lead  trail  ", "\r\n } \r a b c\x1cd e \x1c f \x85 g 　h",
       "日本語 テキスト🏳️‍🌈 é é", "it's they'll  we 've", "x" * 500 + " y", " ", "\x00 \x7f"]


def test_alignment_against_decoded_bytes(spark, edge_docs, no_docs, tokenizers_pair):
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(ODD, 100)), "doc_id long, text string"))
    docs = docs.union(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text"))
    assert rows(alignment.op13(docs)) == plain_op13(tokenizers_pair, texts_of(docs))
    assert alignment.op13(no_docs).collect() == []


def test_rare_pairs_are_joined_without_a_broadcast(spark, edge_docs, tokenizers_pair):
    table = alignment.aligned(edge_docs, A_PATH, B_PATH)
    want = rows(alignment.scored(table))
    assert rows(alignment.scored(table, most=3)) == want == rows(alignment.scored(table, most=0))


def test_groups_tile_the_text(spark, tokenizers_pair):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    got = alignment.groups(docs, A_PATH, B_PATH).collect()
    for doc, text in enumerate(ODD):
        own = sorted((r.start, r.end, r.a_ids, r.b_ids) for r in got if r.doc_id == doc)
        want = plain_alignment(tokenizers_pair, text)[2]
        assert [(a, b) for _, _, a, b in own] == [(a, b) for a, b, _ in want]
        assert [(s, e) for s, e, _, _ in own] == list(zip([0] + [e for *_, e in want], [e for *_, e in want]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=6), st.sampled_from([" ", "  ", "\n", "<|endoftext|>", "'s", "<0x0A>", "😀", "é", "\r"])), max_size=8))
def test_cutting_at_single_blanks_changes_nothing(tokenizers_pair, parts):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    align = alignment.aligner(A_PATH, B_PATH)
    parts = alignment.parts_of(text)
    cuts = [align.tokens(p) for p in parts]
    a, b, groups, _ = plain_alignment(tokenizers_pair, text)
    if not cuts or any(c is None for c in cuts):
        assert not a
    else:
        assert [i for c in cuts for i in c[0]] == a and [i for c in cuts for i in c[2]] == b
        for ids, ends, table in [(c[k], c[k + 1], t) for c in cuts for k, t in ((0, align.a_len), (2, align.b_len))]:
            assert ends.tolist() == np.cumsum(table[ids]).tolist()
        assert "".join(x[4] for x in align.align(parts)) == "".join(
            ",".join(map(str, x)) + "|" + ",".join(map(str, y)) + ";" for x, y, _ in groups)
