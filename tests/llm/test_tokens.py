"""Codes, unit-wise BPE, tree BPE, scores and packing against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import SF
from tidemark.llm import dac, ngram_lm, packing, queries, tree_bpe
from tidemark.llm.token_units import default_path, word_bpe

BYTE, WORD = default_path("byte_bpe_50k.json"), default_path("word_bpe_49k.json")


def rows(df, *by):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def test_codes_give_every_id_back():
    rng = np.random.default_rng(1)
    for ids in (np.empty(0), np.array([0]), np.array([255, 256, 65535, 65536, 2**32 - 1]), rng.integers(0, 50257, 5000), rng.integers(0, 200, 1300)):
        ids = ids.astype(np.uint32)
        c = dac.Codes(dac.pack(ids))
        assert c.n == len(ids) and (c.run(0, len(ids)) == ids).all()
        for i in rng.integers(0, max(1, len(ids)), 60) if len(ids) else []:
            assert c[int(i)] == ids[i]
            n = int(rng.integers(0, len(ids) - i + 1))
            assert (c.run(int(i), n) == ids[i : i + n]).all()
    with pytest.raises(ValueError):
        dac.Codes(b"x" * 40)


def test_units_are_the_library(documents):
    tok, rng = Tokenizer.from_file(BYTE), random.Random(3)
    alphabet = " \n\t\r  \u0085᠎​\x1c ab'sté.,1<|endoftext|>Σ́\U0001f600"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    made += [t or "" for (t,) in documents.select("text").collect()]
    for t, ids in zip(made, word_bpe(BYTE)(made)):
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_trees_are_the_library():
    """Leaves of any size, cut anywhere: inside words, contractions, special tokens and runs without white space."""
    tok, bpe, rng = Tokenizer.from_file(WORD), tree_bpe.TreeBpe(WORD), random.Random(7)
    alphabet = ["<|endoftext|>", "<|startoftext|>", "<|start", "'s", "'ll", "!!'", *" \n\t\u0085\u200b ab'sT\u00e9.,1\u03a3\u0323\u0301\u1e9e\U0001f600\uac01\u09cb\U00010000\u0130"]
    made = ["".join(rng.choice(alphabet) for _ in range(rng.choice((5, 60, 300)))) for _ in range(2000)]
    made += ["".join(rng.choice("aabbcdeorithn") for _ in range(rng.randint(50, 900))) for _ in range(300)]
    made += ["x" * 9000 + " tail", "'s1" * 2000, "=" * 9000, "e" + "\u0301" * 3000 + "x", ""]
    for t in made:
        (node,) = bpe.trees([t], rng.choice((7, 40, 64, 100)))
        ids = tok.encode(t, add_special_tokens=False).ids
        assert node.ids().tolist() == ids, t
        assert bpe.decode(ids) == tok.decode(ids, skip_special_tokens=False)


def test_most_documents_are_joined(spark):
    """Counts over sf0.01: leaves and joins of the whole table, and documents with two leaves at least."""
    texts = [t or "" for (t,) in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    several = [len(tree_bpe.halves(t, tree_bpe.LEAF)) > 2 for t in texts]
    bpe = tree_bpe.TreeBpe(WORD)
    bpe.trees(texts)
    assert sum(several) > 0.6 * len(texts) and bpe.leaves - bpe.joins == len([t for t in texts if t])


def codes_of(tok, docs):
    start, out = 0, []
    for doc_id, text in docs:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_codes(spark, documents):
    expected = codes_of(Tokenizer.from_file(BYTE), documents.orderBy("doc_id").select("doc_id", "text").collect())
    assert rows(queries.op1_token_codes(spark, SF)) == expected


def test_tokens_by_position(spark, documents, monkeypatch):
    """Random access to any token, across segments and shards; the corpus is its documents in order."""
    monkeypatch.setattr(dac, "SEGMENT", 5000)
    tok = Tokenizer.from_file(BYTE)
    whole = [i for _, t in documents.orderBy("doc_id").select("doc_id", "text").collect() for i in [*tok.encode(t or "", add_special_tokens=False).ids, 2]]
    rng = random.Random(5)
    asked = [0, len(whole) - 1, len(whole), -1, None, 7, 7, *(rng.randrange(len(whole)) for _ in range(300))]
    segments = dac.read(spark, dac.write(documents, BYTE, 2))
    got = dac.ids_at(segments, spark.createDataFrame([(i,) for i in asked], "position long"))
    assert Counter((r.position, r.id) for r in got.collect()) == Counter((i, whole[i]) for i in asked if i is not None and 0 <= i < len(whole))
    assert dac.ids_at(segments.where("false"), spark.createDataFrame([(1,)], "position long")).count() == 0


def test_token_codes_of_odd_tables(spark, odd, no_documents):
    got = dac.digests(dac.read(spark, dac.write(odd, BYTE, 2))).collect()
    tok = Tokenizer.from_file(BYTE)
    want = Counter((i, n, c) for i, _, n, c in codes_of(tok, odd.select("doc_id", "text").collect()))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert dac.digests(dac.read(spark, dac.write(no_documents, BYTE, 2))).count() == 0


def tree_expected(docs):
    tok, out = Tokenizer.from_file(WORD), []
    for doc_id, text in docs:
        ids = tok.encode(text or "", add_special_tokens=False).ids
        back = tok.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def test_tree_bpe(spark, documents):
    assert rows(queries.op5_tree_bpe(spark, SF)) == tree_expected(documents.select("doc_id", "text").collect())


def test_tree_bpe_of_odd_tables(odd, no_documents):
    tok = Tokenizer.from_file(WORD)
    got = tree_bpe.encoded(odd, WORD)
    assert got.columns == [*odd.columns, "ids"]
    want = Counter((i, tuple(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in odd.select("doc_id", "text").collect())
    assert Counter((r.doc_id, tuple(r.ids or ())) for r in got.collect()) == want
    assert tree_bpe.encoded(no_documents, WORD).count() == 0


def test_texts_of_several_segments(spark, monkeypatch):
    made = ["x" * 9000 + " a\x1cb c\x1d\x1e d\x1f", "\x1c" * 9000, "a\x1cb" * 3000 + "\x85\u3000\x1f tail", "one two, three's four " * 4000, "short", None, ""]
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in enumerate(made)], "doc_id long, text string, key int, one int, made int")
    tok = Tokenizer.from_file(WORD)
    for segment in (700, tree_bpe.SEGMENT):
        monkeypatch.setattr(tree_bpe, "SEGMENT", segment)
        out = tree_bpe.encoded(docs, WORD, decoded_col="back")
        assert out.columns == [*docs.columns, "ids", "back"]
        got = {r.doc_id: (r.ids, r.back) for r in out.collect()}
        for i, t in enumerate(made):
            ids = tok.encode(t or "", add_special_tokens=False).ids
            assert got[i] == (ids, tok.decode(ids, skip_special_tokens=False)), (i, segment)


def test_words_are_learned_once(monkeypatch):
    """At ends of leaves, at double spaces and at line ends as well."""
    bpe, learned = tree_bpe.TreeBpe(WORD), []
    learn, encode = bpe._learn, bpe._encode
    monkeypatch.setattr(bpe, "_learn", lambda words: learned.extend(words) or learn(words))
    monkeypatch.setattr(bpe, "_encode", lambda words: learned.extend(words) or encode(words))
    texts = [" one  two\nthree ", "two one", "three\n\nÉté one "]
    want = [bpe.tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in bpe(texts)] == want and sorted(filter(None, learned)) == sorted({"one", "two", "three", "Été"})
    bpe.remembered = 2  # then the older half still answers
    assert [x.tolist() for x in bpe(texts)] == want and len(bpe.older) >= 4 and sorted(filter(None, learned)) == sorted({"one", "two", "three", "Été"})


def test_known_words_are_placed_by_their_tokens(monkeypatch):
    bpe = tree_bpe.TreeBpe(WORD)
    words = ["Étéchon", "überau", "cióncoción.", "İx", "e\u0301a", "한글", "x\x85é", "\U0001f600é", "naïve's", "K\u030c"]
    want = [bpe._spans(w) for w in words]
    bpe(words)
    assert [bpe._plain_spans(w) for w in words] == want
    monkeypatch.setattr(bpe, "_spans", None)
    assert [bpe._plain_spans(w) for w in words[:3]] == want[:3]


def test_joins_near_white_space_encode_a_word_only(monkeypatch):
    """The word that a join stands in, once; no other token of either side is looked up or placed."""
    bpe, asked = tree_bpe.TreeBpe(WORD), []
    texts = [f"{i} " + t * 300 for t in ("one two, three's fo\u0301ur ", "l\u00ednea\notra<|endoftext|>x 's", "a  b\n\n\tc!!' \x85d\u3000e ") for i in range(40)]
    want = [bpe.tok.encode(t, add_special_tokens=False).ids for t in texts]
    of = bpe._of
    monkeypatch.setattr(bpe, "placed", None)
    monkeypatch.setattr(bpe, "_of", lambda words: asked.append(words) or of(words))
    assert [n.ids().tolist() for n in bpe.trees(texts, 100)] == want
    assert bpe.joins > 1000 and all(len(w) < 40 for words in asked for w in words)
    assert [n.ids().tolist() for n in bpe.trees(texts, 9)] == want


def lm_expected(texts, order=2):
    tok = Tokenizer.from_file(BYTE)
    ids = [tuple(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]
    counts = [Counter(x[i : i + k] for k in range(1, order + 1) for i in range(len(x) - k + 1)) for x in ids]
    every, total, out = Counter(), sum(map(len, ids)), []
    for own in counts:
        every.update(own)
    for x, own in zip(ids, counts):
        s = 0.0
        for i in range(len(x)):
            most, penalty = min(i + 1, order), 1.0
            for k in range(most, 0, -1):
                g = x[i + 1 - k : i + 1]
                c = every[g] - own[g]
                if c > 0:
                    base = every[g[:-1]] - own[g[:-1]] if k > 1 else total - len(x)
                    s += math.log10(penalty * c / base)
                    break
                penalty *= 0.4
            else:
                s += math.log10(penalty / (total - len(x) + 1))
        out.append((len(x), s))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores(spark, odd, documents, order):
    docs = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    got = ngram_lm.scored(docs, BYTE, order).collect()
    want, have = defaultdict(list), defaultdict(list)
    all_rows = docs.collect()
    for (i, _), x in zip(all_rows, lm_expected([t for _, t in all_rows], order)):
        want[i].append(x)
    for r in got:
        have[r.doc_id].append((r.n_tokens, r.log10_score))
        assert r.log10_mean is None if not r.n_tokens else r.log10_mean == pytest.approx(r.log10_score / r.n_tokens)
    assert want.keys() == have.keys()
    for i in want:
        for a, b in zip(sorted(want[i]), sorted(have[i]), strict=True):
            assert a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-6)


def test_scores_query_sees_two_ids_of_context(spark, documents):
    docs = documents.select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_tokens, r.log10_score) for r in queries.op2_ngram_lm(spark, SF).collect()}
    assert len(got) == len(docs)
    for (i, _), (n, s) in zip(docs, lm_expected([t for _, t in docs], 3)):
        assert got[i] == (n, pytest.approx(s, abs=1e-6))


def shuffled_bytes(spark):
    store, no_quantiles = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = store.stageList(None, False, False, no_quantiles, spark.sparkContext._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_ngrams_travel_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(6).cache()
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    before = shuffled_bytes(spark)
    got = ngram_lm.scored(docs, BYTE, 3).collect()
    assert len(got) == docs.count() and shuffled_bytes(spark) - before < 3 * size


def test_scores_of_four_ids(spark):
    """Ids above 32,767 fill the highest bit of a four-gram's key."""
    tok = Tokenizer.from_file(BYTE)
    words = [w for i in range(40_000, 40_060) if (w := tok.decode([i])).isascii() and tok.encode(w).ids == [i]]
    texts = [" ".join(words[i : i + 12] + ["and"] + words[: i + 3]) for i in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_tokens, r.log10_score) for r in ngram_lm.scored(docs, BYTE, 4).collect()}
    for i, (n, s) in enumerate(lm_expected(texts, 4)):
        assert got[i] == (n, pytest.approx(s, abs=1e-6))


def test_scores_of_no_documents(no_documents):
    assert ngram_lm.scored(no_documents, BYTE).count() == 0
    with pytest.raises(ValueError):
        ngram_lm.scored(no_documents, BYTE, 5)


def check_bins(got, lengths, capacities):
    bins, whole = defaultdict(list), defaultdict(int)
    for r in got:
        bins[r.shard, r.bin].append(r)
        assert 0 < r.length <= max(capacities)
    for items in bins.values():
        items.sort(key=lambda r: r.position)
        at = 0
        for r in items:
            assert r.position == at
            at += r.length
        assert {r.capacity for r in items} == {min(c for c in capacities if c >= at)}
    pieces = Counter((r.doc_id, r.piece, r.start, r.length) for r in got)
    want = Counter()
    for i, n in lengths:
        for k in range(-(-(n or 0) // max(capacities))):
            want[i, k, k * max(capacities), min(max(capacities), n - k * max(capacities))] += 1
    assert pieces == want
    return bins, whole


def test_packing(spark):
    lengths = [(i, n) for i, n in enumerate([5, 8, 3, 3, 20, 1, 0, None, 8, 8, 2, 33])] + [(3, 3), (None, 4), (None, 4)]
    df = spark.createDataFrame(lengths, "doc_id long, length long")
    check_bins(packing.packed(df, (4, 8)).collect(), lengths, (4, 8))
    assert packing.packed(df.where("false")).count() == 0


def test_best_fit_takes_the_fullest_bin():
    bins, used = packing.best_fit([7, 6, 3, 2, 1], [10])
    assert bins == [0, 1, 0, 1, 1] and used == [10, 9]


def test_packing_is_no_worse_than_one_size(spark):
    rng = random.Random(9)
    items = sorted((rng.choice([rng.randint(1, 900), rng.randint(1, 8192)]) for _ in range(4000)), reverse=True)
    bins, final = packing.pack_shard(items)
    alone = packing.best_fit(items, [8192])[1]
    assert sum(map(packing.cost, final)) <= len(alone) * packing.cost(8192)
    assert sum(items) / sum(final) > 0.95


def test_packing_query(spark, documents):
    tok = Tokenizer.from_file(BYTE)
    lengths = [(i, len(tok.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in documents.select("doc_id", "text").collect()]
    check_bins(queries.op4_packing(spark, SF).collect(), lengths, packing.CAPACITIES)
