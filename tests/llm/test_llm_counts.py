"""Token counts, phrase collocations and the Merkle manifest against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest
from fixtures import SCHEMA, odd_documents, odd_rows
from pyspark.sql import functions as F

from sheetloom.llm import collocations, heavy, merkle, pretokens, queries, token_counts

ALPHABET = [*"  \n\n\t 　''''sstmdrevlLa1é日!.́", "<|endoftext|>", "<|end", " 's", "'ll", "'re", "x <|endoftext|> "]


@pytest.fixture(scope="module")
def codec():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_counts.VOCABULARY)


def _length(codec, text: str | None) -> int:
    return len(codec.encode(text or "", add_special_tokens=False).ids)


# Token counts.


def test_classes_and_pieces_are_the_library_s(codec):
    classes = pretokens.character_classes(codec)
    points = (c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 3))
    every = "".join(f"a{chr(c)}1!\n" for c in points)
    own = pretokens.split([every], classes, []).tokens.to_pylist()
    assert own == [every[a:b] for _, (a, b) in codec.pre_tokenizer.pre_tokenize_str(every)]


def test_pieces_of_random_texts(codec):
    dice = random.Random(5)
    classes = pretokens.character_classes(codec)
    texts = ["".join(dice.choice(ALPHABET) for _ in range(dice.randrange(12))) for _ in range(4000)]
    found = pretokens.split(texts, classes, ["<|endoftext|>"])
    tokens, special = found.tokens.to_pylist(), set(found.special.tolist())
    for i, text in enumerate(texts):
        span = range(found.first[i], found.first[i + 1])
        assert "".join(tokens[k] for k in span) == text
        assert sum(1 if k in special else _length(codec, tokens[k]) for k in span) == _length(codec, text), text


def test_parts_of_a_long_text_end_where_a_piece_must():
    text = "one two\n\nthree  four" * 7 + "unbroken" * 20
    parts = list(pretokens.pieces(text, 10))
    assert "".join(parts) == text and len(parts) > 5
    assert all(p[0].isspace() and not q[-1].isspace() for p, q in zip(parts[1:], parts))


def test_token_counts_equal_the_library_s(spark, codec):
    dice = random.Random(6)
    rows = [(i, "".join(dice.choice(ALPHABET) for _ in range(dice.randrange(60))), None, None, None) for i in range(300)]
    docs = odd_documents(spark, odd_rows() + rows).repartition(5)
    got = sorted(map(str, token_counts.count_tokens(docs, frequent=40).collect()))
    want = [(r.doc_id, len((r.text or "").encode()), _length(codec, r.text)) for r in docs.select("doc_id", "text").collect()]
    assert got == sorted(f"Row(doc_id={a}, n_bytes={b}, n_tokens={c})" for a, b, c in want)
    assert token_counts.count_tokens(odd_documents(spark, [])).count() == 0


def test_token_counts_of_the_whole_table(spark, codec):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op13_token_counts(spark, sf_dir).collect():
        n = _length(codec, texts[r.doc_id])
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 1024, len(texts[r.doc_id].encode()))


def test_vocabularies_of_another_kind_are_refused():
    with open("/opt/tokenizers/word_bpe_49k.json", "rb") as file, pytest.raises(ValueError):
        pretokens.special_strings(file.read())


def test_summaries_keep_what_is_frequent():
    dice = random.Random(1)
    items = ["hot"] * 3000 + ["warm"] * 1500 + [f"x{dice.randrange(5000)}" for _ in range(9000)]
    dice.shuffle(items)
    parts = []
    for start in range(0, len(items), 1000):
        part = heavy.Summary(50)
        part.add(items[start : start + 1000], [1] * 1000)
        parts.append(part.batch())
    whole = heavy.Summary(50)
    for part in parts:
        whole.add(part["items"][0].as_py(), part["counts"][0].as_py())
    whole.cut()
    assert len(whole.counts) <= 50
    assert 3000 - len(items) / 50 <= whole.counts["hot"] <= 3000 and whole.counts["warm"] <= 1500


# Collocations.


def _plain_collocations(rows, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang, text = lang or "und", (text or "").translate({c: c + 32 for c in range(65, 91)})
        for c in ".,;:!?\n\x0b\x0c\r":
            text = text.replace(c, "\n")
        for piece in text.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            n[lang] += len(words)
            for size in (1, 2, 3):
                f.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    out = {}
    long = {p: a for p, a in f.items() if len(p) == 4 and a >= 10}
    inner = Counter()
    for (lang, *w), a in long.items():
        for part in ((lang, w[0], w[1]), (lang, w[1], w[2])):
            inner[part] = max(inner[part], a)
    for (lang, *w), a in f.items():
        if len(w) < 2 or a < 10 or (len(w) == 2 and 100 * inner[(lang, *w)] >= 50 * a):
            continue
        cuts = [(f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w))]
        score, _, (left, right) = min((1_000_000 * a * a // (x * y), k, (x, y)) for k, (x, y) in enumerate(cuts))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
        for lang, found in out.items()
        for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])
    )


def _collocation_rows():
    dice = random.Random(11)
    words = [f"w{i}" for i in range(30)] + ["The", "ÄB", "the", "日本"]
    rows = []
    for i in range(400):
        text = "".join(dice.choice(words) + dice.choice([" ", " ", " ", "\t", ". ", "\r\n", "  ", ";"]) for _ in range(80))
        rows.append((i, text + "hot pair once" * dice.randrange(3), dice.choice(["en", "en", "de", None, "und"]), None, None))
    return rows + odd_rows() + [(1000, "alpha beta gamma " * 30_000, "en", None, None)]


@pytest.mark.parametrize("size", [6 << 20, 2000])
def test_collocations_equal_a_plain_count(spark, monkeypatch, size):
    """Also with many small flushes, merged some keys at a time, and with stripes that are split."""
    if size < 10_000:
        monkeypatch.setattr(collocations, "BYTES", size)
        monkeypatch.setattr(collocations, "ENTRIES", 20)
        monkeypatch.setattr(collocations, "SHARE", 1 / 64)
    rows = _collocation_rows()
    docs = odd_documents(spark, rows).repartition(4)
    got = sorted(tuple(r) for r in collocations.collocations(docs, top=200).collect())
    assert got == _plain_collocations([(r[1], r[2]) for r in rows], 200)


def test_collocations_of_little(spark):
    docs = odd_documents(spark, [])
    assert collocations.collocations(docs).count() == 0
    docs = odd_documents(spark, [(1, None, None, None, None), (2, "one two", "en", None, None)])
    assert collocations.collocations(docs).count() == 0


def test_scores_are_exact_where_products_pass_64_bits(spark):
    rows = [(3_000_000_007, 4_000_000_019, 5_000_000_021), (9_999_999_999_999, 9_999_999_999_999, 9_999_999_999_999), (10, 10, 11)]
    df = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", collocations._score("a", "l", "r").alias("s"))
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in df.collect())


# The Merkle manifest.


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def _leaf(row, more: int = 0) -> str:
    values = [row[0], row[3], row[2], row[4] if row[4] is None else row[4] + more, row[1]]
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _plain_manifest(rows) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
    trees = [_levels([_leaf(r) for r in groups[g]]) for g in order]
    crown = _levels([t[-1][0] for t in trees])
    root, out = crown[-1][0], []
    for k, (group, tree) in enumerate(zip(order, trees)):
        for i, row in enumerate(groups[group]):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node, proof = _leaf(row, int(tampered)), ""
            for levels, at in ((tree, i), (crown, k)):
                for level in levels[:-1]:
                    first = at & ~1
                    run = level[first : first + 2]
                    proof += "".join(x for j, x in enumerate(run) if first + j != at)
                    node = _h(*(node if first + j == at else x for j, x in enumerate(run)))
                    at >>= 1
            out.append((row[0], _leaf(row), tree[-1][0], root, _h(proof), node, node == root))
    return out


def _manifest(docs):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in columns]
    marked = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)
    return merkle.dataset_manifest(docs, columns=columns, tampered=tampered, tampered_rows=marked)


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_manifest_equals_a_plain_tree(spark, monkeypatch, bits):
    """Also over several rounds of small tiles, with groups of one row and repeated rows."""
    monkeypatch.setattr(merkle, "BITS", bits)
    rows = odd_rows() + [(i, f"text {i}", "en" if i % 3 else "de", "s", i if i % 5 else None) for i in range(100, 143)]
    rows += [(7, "again", f"l{i}", None, 1) for i in range(5)]
    got = sorted(map(str, (tuple(r) for r in _manifest(odd_documents(spark, rows).repartition(7)).collect())))
    assert got == sorted(map(str, _plain_manifest(rows)))


def test_manifest_of_nothing_and_of_one(spark):
    assert _manifest(odd_documents(spark, [])).count() == 0
    (only,) = _manifest(odd_documents(spark, [(3, "t", "en", None, 1)])).collect()
    assert only.leaf == only.subroot == only.root == only.folded_root and only.proof_sha256 == _h("") and only.verified


def test_positions_are_those_of_the_log():
    for n in range(1, 40):
        levels = merkle.height(n)
        builder = merkle.Builder(n, levels)
        for i in range(n):
            builder.append(bytes([i]) * 32)
        nodes, level = [bytes([i]) * 32 for i in range(n)], 0
        while True:
            assert [builder.log[merkle.position(level, i, n)] for i in range(len(nodes))] == nodes
            if level == levels:
                break
            nodes = [merkle.digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
            level += 1
        assert len(builder.log) == merkle.position(levels, 0, n) + 1


def test_rows_of_the_new_queries_are_whole(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    assert sorted(map(str, (r[0] for r in _manifest(docs).select("doc_id").collect()))) == sorted(str(r[0]) for r in odd_rows())
