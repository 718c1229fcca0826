"""Prefix counts, alignment and fill-in-middle forms against the libraries and plain loops."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tests.llm.conftest import SF
from tidemark.llm import alignment, fill_middle, prefix_counts, queries
from tidemark.llm.token_units import default_path

BYTE, PIECE = default_path("byte_bpe_50k.json"), default_path("piece_bpe_32k.model")
ALPHABET = [*" \n\t\x00ab'sté.,1▁Σ\U0001f600-=#", "the", "ing", "  ", "    ", "<s>", "</s>", "<unk>", "<0x41>", "▁▁", "<|endoftext|>", "<P>"]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def made(n=1500, seed=1):
    rng = random.Random(seed)
    odd = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return [*odd, "x" * 3000, "=-" * 800, "".join(rng.choice("aabbcdeorithn") for _ in range(2000)), " ", "  ", " a", "a ", "\n \n"]


def test_counts_of_every_prefix():
    """Sums of changes up to a code point against the library on that prefix alone."""
    model, counter, rng = SentencePieceProcessor(model_file=PIECE), prefix_counts.PrefixCounts(PIECE), random.Random(2)
    texts = made()
    for t, changes in zip(texts, counter(texts), strict=True):
        assert len(changes) == len(t)
        sums = np.cumsum(changes)
        for k in {0, len(t), *(rng.randint(0, len(t)) for _ in range(4))}:
            assert (int(sums[k - 1]) if k else 0) == len(model.encode(t[:k])), (t, k)


def test_counter_forgets_and_stays_right(documents):
    model, counter = SentencePieceProcessor(model_file=PIECE), prefix_counts.PrefixCounts(PIECE, remembered=50)
    texts = [t or "" for (t,) in documents.select("text").limit(40).collect()]
    for i in range(0, 40, 10):
        assert [int(x.sum()) for x in counter(texts[i : i + 10])] == [len(x) for x in model.encode(texts[i : i + 10])]


def test_stored_counts_answer_questions(spark, documents):
    model = SentencePieceProcessor(model_file=PIECE)
    texts = {r.doc_id: r.text or "" for r in documents.limit(30).collect()}
    table = prefix_counts.count_table(documents.where(documents.doc_id.isin(list(texts))), PIECE)
    rng = random.Random(4)
    asks = [(i, p) for i, t in texts.items() for p in (-3, 0, len(t), len(t) + 9, rng.randint(0, len(t)), prefix_counts.STEP)] + [(None, 1), (1, None), (10**9, 1)]
    got = prefix_counts.counts_at(table, spark.createDataFrame(asks, "doc_id long, position long")).collect()
    want = Counter((i, p, len(model.encode(texts[i][: max(0, p)]))) for i, p in asks if i in texts and p is not None)
    assert Counter(map(tuple, got)) == want
    for r in prefix_counts.answers(table, 20).collect():
        t = texts[r.doc_id]
        assert r.chars_within == max(k for k in range(len(t) + 1) if len(model.encode(t[:k])) <= 20) if len(t) < 400 else r.chars_within >= 20


def counts_expected(rows):
    model = SentencePieceProcessor(model_file=PIECE)
    return order((i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in rows)


def test_token_counts(spark, documents):
    got = queries.op11_prefix_counts(spark, SF)
    assert got.columns[:4] == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert order(tuple(r)[:4] for r in got.collect()) == counts_expected(documents.select("doc_id", "text").collect())


def test_token_counts_of_odd_tables(odd, no_documents):
    got = prefix_counts.answers(prefix_counts.count_table(odd, PIECE), 4096).collect()
    assert order(tuple(r)[:4] for r in got) == counts_expected(odd.select("doc_id", "text").collect())
    assert prefix_counts.answers(prefix_counts.count_table(no_documents, PIECE), 4096).count() == 0


def test_large_changes_are_kept():
    x = np.array([1, -1000, 5])
    assert (prefix_counts._unpacked(prefix_counts._packed(x), 3) == x).all()
    assert prefix_counts.count_at([], prefix_counts._packed(x), 3, 2) == -999


def plain_alignment(rows):
    """By definition: tokens of whole texts, ends that both sides have, all pairs in a group."""
    a_tok, model = Tokenizer.from_file(BYTE), SentencePieceProcessor(model_file=PIECE)
    a_tok.encode_special_tokens = True
    codes = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in codes} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(codes)))}
    found, holders = [], Counter()
    for doc_id, t in rows:
        whole = (" " + (t or "")).encode()
        a = a_tok.encode(" " + (t or ""), add_special_tokens=False).ids
        b = model.encode(t or "")
        bytes_a = [bytes(of[c] for c in a_tok.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(model.id_to_piece, b)]
        if not t or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            found.append((doc_id, [], [], [], Counter()))
            continue
        ends_a, ends_b = np.cumsum(list(map(len, bytes_a))).tolist(), np.cumsum(list(map(len, bytes_b))).tolist()
        groups, lo = [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            groups.append(([x for x, e in zip(a, ends_a) if lo < e <= end], [x for x, e in zip(b, ends_b) if lo < e <= end]))
            lo = end
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        holders.update(links.keys())
        found.append((doc_id, a, b, groups, links))
    best = defaultdict(int)
    for (x, _), n in holders.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, a, b, groups, links in found:
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        n_best = sum(n for p, n in links.items() if holders[p] == best[p[0]])
        digest = hashlib.sha256(said.encode()).hexdigest() if groups else ""
        out.append((doc_id, len(a), len(b), len(groups), sum(links.values()), n_best, sum(n * holders[p] for p, n in links.items()), digest))
    return order(out)


def test_alignment(spark, documents):
    assert order(map(tuple, queries.op12_alignment(spark, SF).collect())) == plain_alignment(documents.select("doc_id", "text").collect())


@pytest.mark.parametrize("small", [False, True])
def test_alignment_of_odd_tables(spark, odd, no_documents, monkeypatch, small):
    """With small partitions most stripes are split, and the sums stay."""
    rows = [(i, t) for i, t in enumerate(made(300, 5))] + [(7, "a a a a"), (7, "a a a a"), (8, "▁a"), (9, "a\x00b")] + [tuple(r) for r in odd.select("doc_id", "text").collect()]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, stripe string, chunk int").repartition(3)
    if small:
        monkeypatch.setattr(alignment, "LINKS", 60)
    assert order(map(tuple, alignment.aligned(docs, BYTE, PIECE).collect())) == plain_alignment(rows)
    assert alignment.aligned(no_documents, BYTE, PIECE).count() == 0


def test_units_in_small_batches_and_with_large_groups(monkeypatch):
    """Whatever is aligned at once, and whether or not a unit's links are counted by distinct ids."""
    texts = [t for t in made(400, 11) if t] + ["word", "zq" * 40, "a b"]
    whole = alignment.Aligner(BYTE, PIECE).units(texts)
    assert sum(u is None for u in whole) == sum("▁" in t for t in texts)
    for most in (1, 300):
        monkeypatch.setattr(alignment, "AT_ONCE", most)
        assert alignment.Aligner(BYTE, PIECE, remembered=10).units(texts) == whole


def forms_expected(rows, seed=42):
    out = []
    for doc_id, t in rows:
        t = t or ""
        tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", t)
        n, digits = len(tokens), hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
        i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        pre, mid, suf = ("".join(tokens[a:b]) for a, b in ((0, i), (i, j), (j, n)))
        if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
            form, got, lengths = "plain", t, (None, None)
        elif h[3] % 100 < 80:
            form, got, lengths = "spm", f"<S>{suf}<P>{pre}<M>{mid}", (len(pre), len(mid))
        else:
            form, got, lengths = "psm", f"<P>{pre}<S>{suf}<M>{mid}", (len(pre), len(mid))
        out.append((doc_id, n, form, *lengths, *(hashlib.sha256(x.encode()).hexdigest() for x in (got, t))))
    return order(out)


def test_boundary_lists():
    rng = np.random.default_rng(6)
    lists = [np.empty(0, np.int64), np.array([1]), np.array([10**6]), np.arange(1, 5000), np.cumsum(rng.integers(1, 3000, 4000)), np.cumsum(rng.integers(1, 3, 9000))]
    for values in lists:
        e = fill_middle.EliasFano.of(values)
        again = fill_middle.EliasFano(e.n, e.low_bits, e.low.tobytes(), e.high.tobytes())
        assert [again[k] for k in range(len(values))] == values.tolist()
    for t in made(800, 3):
        assert fill_middle.token_ends(t).tolist() == [x.end() for x in re.finditer(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", t)]


def test_fill_middle(spark, documents):
    assert order(map(tuple, queries.op13_fill_middle(spark, SF).collect())) == forms_expected(documents.select("doc_id", "text").collect())


def test_fill_middle_of_odd_tables(spark, odd, no_documents, monkeypatch):
    """Texts that end or begin with parts of markers, many copies in several groups, repeated rows and null ids."""
    rows = [(i, t) for i, t in enumerate(made(200, 8))] + [tuple(r) for r in odd.select("doc_id", "text").collect()]
    rows += [(1000 + i, x) for i in range(40) for x in ("copy of one text", "<S <P S> P>< M> <", None, "<P> marked", " \n")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, part int, hash string").repartition(5)
    monkeypatch.setattr(fill_middle, "COPIES", 7)
    texts = {(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars): r for r in fill_middle.transformed(docs).collect()}
    got = fill_middle.transformed(docs)
    back = fill_middle.restored(got.output, got.form)
    have = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, hashlib.sha256(r.output.encode()).hexdigest(), hashlib.sha256(r.back.encode()).hexdigest()) for r in got.withColumn("back", back).collect()]
    assert order(have) == forms_expected(rows) and len(texts) > 100
    listed = fill_middle.index(docs).where("text = 'copy of one text'").collect()
    assert 2 < len(listed) <= 6 and sorted(i for r in listed for i in r.ids) == [1000 + i for i in range(40)]
    assert fill_middle.index(docs).where("text <> ''").groupBy("text").count().where("count > 6").count() == 0
    assert fill_middle.transformed(no_documents).count() == 0
