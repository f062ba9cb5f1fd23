"""Operators without SQL against plain versions: toxicity, language ID, training order, tokenisation, paraphrases."""

from __future__ import annotations

import hashlib
import math
import random
import struct

import numpy as np
from fixtures import words

from sheetloom.llm import chat, decontaminate, language, mixing, stages, token_shards, tokens, toxicity
from sheetloom.llm.ngrams import hashed
from sheetloom.llm.tokens import Bpe, vocabulary_path

MASK = (1 << 64) - 1


def _bucket(gram: str, bits: int) -> int:
    h = len(gram)
    for c in gram:
        h = (h * 0x9E3779B97F4A7C15 + ord(c)) & MASK
    h ^= h >> 32
    return ((h * 0xD6E8FEB86659FD93) & MASK) >> (64 - bits)


def _grams(text: str, orders: tuple[int, ...], bits: int) -> set[int]:
    found = set()
    for word in text.split():
        padded = f" {word} "
        found |= {_bucket(padded[i : i + n], bits) for n in orders for i in range(len(padded) - n + 1)}
    return found


def test_buckets_of_grams():
    codes = np.frombuffer(" abc de ".encode("utf-32-le"), np.uint32)
    for n in (3, 4, 5):
        assert set(hashed(codes, n, 20)[1].tolist()) == _grams("abc de", (n,), 20)


def test_toxicity_equals_a_plain_classifier(spark):
    """Plain ratios, and the regression's optimum by Newton steps, which the operator's 300 steps come close to."""
    dice = random.Random(2)
    vocabulary = ["".join(dice.choice("abcde") for _ in range(4)) for _ in range(14)]
    rows = []
    for i in range(120):
        toxic = i % 3 == 0
        text = [dice.choice(vocabulary) for _ in range(6)] + (["vile"] if toxic and dice.random() < 0.8 else [])
        rows.append((i, " ".join(text), int(toxic if dice.random() < 0.95 else not toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, labels)).collect()}
    grams = [_grams(r[1], toxicity.ORDERS, toxicity.BITS) for r in rows]
    y = np.array([r[2] for r in rows], float)
    features = sorted(set.union(*grams))
    assert len(features) < toxicity.FEATURES
    x = np.array([[f in g for f in features] for g in grams], float)
    k1, k0, m1, m0 = x[y == 1].sum(0), x[y == 0].sum(0), y.sum(), (1 - y).sum()
    x *= np.log((k1 + 1) / (m1 + 2)) - np.log((k0 + 1) / (m0 + 2))
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([1e-4] * len(features) + [0.0])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (p - y) / len(y) + ridge @ w
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x / len(y) + ridge + 1e-9 * np.eye(len(w)), gradient)
    prior = (m1 + 0.5) / (m1 + m0 + 2)
    shift = math.log(prior / (1 - prior)) - math.log((m1 + 0.5) / (m0 + 1.5))
    want = 1 / (1 + np.exp(-(x @ w + shift)))
    found = np.array([got[r[0]] for r in rows])
    assert np.abs(found - want).max() < 0.1 and np.abs(found - want).mean() < 0.02
    clear = np.abs(want - 0.5) > 0.1
    assert ((found >= 0.5) == (want >= 0.5))[clear].all() and clear.mean() > 0.8


def _plain_mixture(likes: list[list[float]]) -> list[float]:
    """Sets of languages by the order of their share in the mixture of all, each fitted by plain EM."""
    n, k = len(likes), len(likes[0])
    cost = language.PENALTY * 0.5 * math.log(n + 1)
    relative = [[math.exp(v - max(row)) for v in row] for row in likes]

    def fit(allowed: list[int]) -> tuple[list[float], float]:
        share = [1 / len(allowed) if j in allowed else 0.0 for j in range(k)]
        for _ in range(400):
            new = [0.0] * k
            for row in relative:
                joint = [s * v for s, v in zip(share, row)]
                new = [a + b / sum(joint) / n for a, b in zip(new, joint)]
            share = new
        return share, sum(math.log(sum(s * v for s, v in zip(share, row))) for row in relative)

    singles = [sum(row[j] - max(row) for row in likes) for j in range(k)]
    one = max(range(k), key=lambda j: singles[j])
    best, score = [float(j == one) for j in range(k)], singles[one] - cost
    order = sorted(range(k), key=lambda j: -fit(list(range(k)))[0][j])
    for size in range(2, k + 1):
        share, whole = fit(order[:size])
        if whole - size * cost > score:
            best, score = share, whole - size * cost
    return best


def test_language_mixtures_equal_plain_em():
    dice = random.Random(4)
    for _ in range(12):
        mix = dice.choice([[1, 0, 0], [0.6, 0.4, 0], [0.34, 0.33, 0.33]])
        likes = []
        for _ in range(120):
            own = dice.choices(range(3), mix)[0]
            likes.append([-2 - 6 * (j != own) + dice.gauss(0, 0.8) for j in range(3)])
        found = language.infer_mixtures(np.array(likes), np.array([0]))[0]
        assert np.abs(found - np.array(_plain_mixture(likes))).max() < 0.02


def test_texts_without_a_letter_have_no_language(spark):
    docs = [(1, "hola que tal amigo", "es"), (2, "hello how are you", "en"), (3, "́", None), (4, "́ 12 ̀", None), (5, "12 !", None), (6, "é", None)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in language.detect_languages(table, language.train_languages(table)).collect()}
    assert all((out[i].lang_pred, out[i].score) == ("und", 0.0) for i in (3, 4, 5))
    assert out[1].lang_pred == "es" and out[2].lang_pred == "en" and out[6].lang_pred != "und"


def test_ids_do_not_depend_on_the_length(monkeypatch):
    dice = random.Random(8)
    bpe = Bpe(vocabulary_path())
    texts = ["".join(dice.choice("日本語中文字漢") for _ in range(900)), words(3, 300) + " \n\n  don't  x" * 40, " " * 500 + "a" * 700]
    whole = [bpe._codec.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(tokens, "PIECE", 50)
    assert [bpe.encode(t).tolist() for t in texts] == whole


def test_bins_are_even_where_probabilities_are_not(spark):
    for p in (0.0005, 0.01, 0.5, 0.99, 0.9995):
        u = spark.range(20_000).selectExpr("(id + 0.5) / 20000 AS u", f"CAST({p} AS DOUBLE) AS p")
        z = u.selectExpr("u * (1 - p) / (u * (1 - p) + (1 - u) * p) AS z", "p", "u")
        bins = z.select(mixing._evened("z", z["p"]).alias("e"), "u").collect()
        counts = np.bincount([int(r.e * 64) for r in bins])
        assert counts.max() < 1.1 * 20_000 / 64
        assert [r.e for r in sorted(bins, key=lambda r: r.u)] == sorted(r.e for r in bins)


def _plain_slot(index: int, n: int, key: int) -> int:
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    keys = [struct.unpack("<Q", hashlib.sha256(f"{key}:{r}".encode()).digest()[:8])[0] for r in range(token_shards.ROUNDS)]
    while True:
        left, right = index >> half, index & mask
        for k in keys:
            x = right ^ k
            x = ((x ^ (x >> 33)) * 0xFF51AFD7ED558CCD) & MASK
            x = ((x ^ (x >> 29)) * 0xC4CEB9FE1A85EC53) & MASK
            left, right = right, left ^ ((x ^ (x >> 32)) & mask)
        index = left << half | right
        if index < n:
            return index


def test_training_order_equals_a_plain_one(spark):
    """Sequences of a plainly cut stream, each at the slot of a plain permutation."""
    rows = [(i, words(i, 5 + i * 7 % 90)) for i in range(120)] + [(200, None), (201, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    folder = token_shards.new_folder(spark)
    manifest = {r.sequence: r for r in token_shards.write_training_order(docs, folder, length=64, shard_size=16).collect()}
    bpe = Bpe(vocabulary_path())
    stream = [t for _, text in rows for t in (*bpe._codec.encode_ordinary(text or ""), bpe.size)]
    n = -(-len(stream) // 64)
    stream += [bpe.size] * (n * 64 - len(stream))
    cut = [stream[i * 64 : (i + 1) * 64] for i in range(n)]
    slots = [_plain_slot(i, n, 42) for i in range(n)]
    assert sorted(slots) == list(range(n)) == sorted(manifest)
    for i in range(n):
        row = manifest[i]
        assert (row.slot, row.shard, row.byte_offset) == (slots[i], slots[i] // 16, slots[i] % 16 * 128)
        assert row.sha256 == hashlib.sha256(np.array(cut[i], "<u2").tobytes()).hexdigest()
    read = {r.slot: list(r.ids) for r in token_shards.read_training_order(spark, folder).collect()}
    assert read == {s: cut[i] for i, s in enumerate(slots)}


def test_a_stage_leaves_the_tables_of_other_runs(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    tables = [spark.createDataFrame([(i, words(i + k, 80), "en", "s", 1) for i in range(5)], schema) for k in (0, 100)]
    first = stages.quality_rules(spark, tables[0], "/a")
    second = stages.quality_rules(spark, tables[1], "/b")
    again = stages.quality_rules(spark, tables[1], "/a")
    assert [t.count() for t in (first, second, again)] == [5, 5, 5]


def _paraphrase(item: str, share: float, dice: random.Random, swaps: int) -> str:
    """An item of which a share of the words is kept, the answer among them, and neighbours change places."""
    parts = item.split()
    body = range(len(parts) - decontaminate.ANSWER_WORDS)
    for i in dice.sample(body, min(len(body), round((1 - share) * len(parts)))):
        parts[i] = f"zq{dice.randrange(10**6)}"
    for _ in range(swaps):
        j = dice.randrange(len(body) - 1)
        parts[j], parts[j + 1] = parts[j + 1], parts[j]
    return " ".join(parts)


def test_paraphrases_are_found_in_the_latent_space(spark, monkeypatch):
    dice = random.Random(12)
    bench = [(i, words(7000 + i, 40, 3000)) for i in range(60)]
    docs, wanted = [], {}
    for share in (0.8, 0.7, 0.6):
        for i, item in bench:
            doc = len(docs)
            wanted[doc] = (share, i)
            docs.append((doc, " ".join([words(9000 + doc, 100, 3000), _paraphrase(item, share, dice, 4), words(20_000 + doc, 90, 3000)])))
    clean = [(10_000 + i, words(50_000 + i, 200, 3000)) for i in range(200)]
    table = spark.createDataFrame(docs + clean, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")

    def found():
        return {(r.doc_id, i) for r in decontaminate.find_leaks(table, items).collect() for i in r.item_ids}

    hits = found()
    for share in (0.8, 0.7, 0.6):
        own = [(d, i) in hits for d, (s, i) in wanted.items() if s == share]
        assert sum(own) >= 0.9 * len(own), share
    assert not [d for d, _ in hits if d >= 10_000]
    monkeypatch.setattr(decontaminate, "COSINE", 9.0)
    without = found()
    assert sum((d, i) in without for d, (s, i) in wanted.items() if s == 0.6) < 0.5 * len(bench)


def test_chat_of_odd_rows(spark):
    """Null texts, roles, turns and ids, tied and repeated turns, a very long text, and clashing columns."""
    rows = [
        (1, 0, "user", None),
        (1, 1, None, "no role"),
        (1, 2, "assistant", ""),
        (1, 2, "assistant", "tied b"),
        (1, 2, "assistant", "tied a"),
        (1, 3, "assistant", "twice"),
        (1, 3, "assistant", "twice"),
        (1, None, "system: </turn>", "a null turn ### \\### x"),
        (2, 0, "assistant", "日本語 " * 40_000 + "x" * 60_000),
        (None, 0, "user", "null id"),
        (None, 0, None, None),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clashing = table.selectExpr("*", "'x' AS tie", "'x' AS ids", "'x' AS loss", "'x' AS place", "'x' AS start", "'x' AS middle")
    turns = chat.format_turns(clashing.repartition(4))
    got = {r.conv_id: r for r in chat.conversation_digests(turns).collect()}
    groups: dict = {}
    for conv, turn, role, text in rows:
        tie = hashlib.md5(f"{role or ''}\n{text or ''}".encode()).hexdigest()
        groups.setdefault(conv, []).append((turn is not None, turn or 0, tie, role or "", text or ""))
    assert set(got) == set(groups)
    for conv, own in groups.items():
        own.sort()
        learned = "".join(text for *_, role, text in own if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in own)
        shown = sum(
            len(chat.OPEN + chat.escape(role, chat.IN_ROLE) + chat.MIDDLE + chat.escape(text) + chat.CLOSE) for *_, role, text in own
        )
        row = got[conv]
        assert (row.n_turns, row.loss_chars, row.formatted_chars) == (len(own), len(learned), shown)
        assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    places = sorted((r.conv_id or 0, r.place, r.start, len(r.ids)) for r in turns.collect())
    for (conv, place, start, size), (other, following, begin, _) in zip(places, places[1:]):
        assert other != conv or (following, begin) == (place + 1, start + size)
