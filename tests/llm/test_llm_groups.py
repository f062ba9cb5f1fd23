"""Near-duplicates, leaks, wrappers and shards against brute force and round trips."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from fixtures import odd_documents, odd_rows, words

from sheetloom.llm import decontaminate, html_extract, simhash, token_shards
from sheetloom.llm.components import connected_components
from sheetloom.llm.tokens import Bpe, vocabulary_path
from sheetloom.llm.wrapper import Node, assign_roles, main_texts, parse, shape


def plain_fingerprint(text):
    found = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or [b" ".join(found)]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(prints):
    """``[(id, fingerprint)]`` -> the ids of each group of linked rows, and each row's group, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(prints):
        groups.setdefault(find(i), []).append(doc)
    return groups, [find(i) for i in range(len(prints))]


def plain_components(prints):
    groups, group = plain_groups(prints)
    first = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return [first[g] for g in group]


def test_simhash_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    near = [(10_000 + i, words(5, 400) + f" tail{i}") for i in range(30)]
    odd = [(r[0] and r[0] + 50_000, r[1]) for r in odd_rows()]
    rows += near + odd
    out = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    expected = sorted(((str(d), f"{p:016x}", c) for (d, p), c in zip(prints, plain_components(prints))), key=str)
    assert sorted(((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in out), key=str) == expected
    kept = simhash.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(
        str(min((d for d in ids if d is not None), default=None)) for ids in plain_groups(prints)[0].values()
    )


@pytest.mark.parametrize("homes", [2000, 20])
def test_links_of_chains_and_crowds(spark, monkeypatch, homes):
    """Chains of fingerprints 1 to 3 bits apart, a crowd at one anchor, and pairs at distance 4."""
    monkeypatch.setattr(simhash, "HOMES", homes)
    dice = random.Random(3)
    points = set()
    for _ in range(60):
        p = dice.getrandbits(64)
        for _ in range(8):
            points.add(p)
            for bit in dice.sample(range(64), dice.randint(1, 4)):
                p ^= 1 << bit
    crowd = dice.getrandbits(62)
    points |= {crowd ^ (a << 62) ^ (1 << b) ^ (1 << c) for a in range(4) for b in range(31, 62) for c in range(31, 62, 7)}
    points = sorted(points)
    table = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in points], "fp long")
    links = connected_components(simhash.fingerprint_links(table)).collect()
    root = {r["node"] % 2**64: r["root"] % 2**64 for r in links}
    expected = plain_components([(i, p) for i, p in enumerate(points)])
    groups: dict = {}
    for p, c in zip(points, expected):
        groups.setdefault(c, set()).add(root.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_every_near_block_shares_an_anchor():
    """The covering property: homes of a point are anchors of all points one bit away in the block."""
    dice = random.Random(5)
    fps = np.array([dice.getrandbits(62) for _ in range(40)] + [0, (1 << 62) - 1], np.int64)
    for bit in range(62):
        for x, y in zip(fps, fps ^ (1 << bit)):
            keys = [set(simhash._anchors(np.array([p]))[0].tolist()) for p in (x, y)]
            block = bit // 31
            home = next(k for k in keys[0] if not k & 1 and k >> 32 == block)
            assert {home, home | 1} & keys[1]


def test_leaks_of_all_kinds(spark):
    item = words(11, 45, 3000)
    parts = item.split()
    swapped = parts[:]
    for i in range(2, 33, 4):
        swapped[i] = f"other{i}"
    docs = [
        (1, words(1, 300, 3000) + "\n" + item.upper() + ", " + words(2, 77, 3000)),
        (2, words(3, 300, 3000) + " " + " ".join(swapped) + " " + words(4, 30, 3000)),
        (3, words(5, 300, 3000)),
        (4, words(6, 200, 3000) + " " + " ".join(sorted(parts)) + " end"),
        (5, " ".join(parts[:5]) + words(7, 100, 3000)),
        (6, "see the magic phrase here: open sesame now"),
        (7, "now sesame open"),
        (8, None),
    ]
    bench = [(100, item), (101, "open, SESAME now!"), (102, None), (103, " ... "), (104, words(12, 90, 3000))]
    out = {
        r["doc_id"]: r
        for r in decontaminate.find_leaks(
            spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
        ).collect()
    }
    assert out[1]["item_ids"] == [100] and out[1]["score"] == 1.0
    assert out[2]["item_ids"] == [100] and 0.6 <= out[2]["score"] < 1
    assert out[6]["item_ids"] == [101]
    assert not any(out[i]["contaminated"] for i in (3, 4, 5, 7, 8))


def test_paraphrase_needs_the_answer(spark):
    item = words(21, 40, 3000)
    parts = item.split()
    with_answer = [w if i % 2 and i < 28 or i >= 32 else f"x{i}" for i, w in enumerate(parts)]
    without = [w if (i % 2 or i < 12) and i < 32 else f"x{i}" for i, w in enumerate(parts)]
    docs = [(1, " ".join(with_answer)), (2, " ".join(without))]
    docs += [(100 + i, words(100 + i, 200, 3000)) for i in range(60)]
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    out = {r["doc_id"]: r for r in decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert out[1]["contaminated"] and out[1]["score"] < 0.6
    assert not out[2]["contaminated"]


def test_leaks_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    items = {r["item_id"]: " ".join(re.findall(r"\w+", r["text"].lower())) for r in bench.collect()}
    expected = set()
    for r in docs.collect():
        text = f" {' '.join(re.findall(r'[^\W_]+', r['text'].lower()))} "
        expected |= {(r["doc_id"], i) for i, t in items.items() if f" {t} " in text}
    found = {(r["doc_id"], i) for r in decontaminate.find_leaks(docs, bench).collect() for i in r["item_ids"]}
    assert found == expected and expected


def test_no_verbatim_passage_is_lost(spark):
    """Thousands of passages of 15 words and fewer, each pasted unchanged between other words of the benchmark."""
    bench = [(i, words(5000 + i, 15 if i % 10 else 5)) for i in range(3000)]
    docs = [(i, " ".join([words(20_000 + i, 37 + i % 60), bench[i * 5][1], words(40_000 + i, 90)])) for i in range(600)]
    expected = {(d, i) for d, text in docs for i, item in bench if f" {item} " in f" {text} "}
    table, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    found = {(r["doc_id"], i) for r in decontaminate.find_leaks(table, items).collect() for i in r["item_ids"]}
    assert expected <= found and {(d, d * 5) for d, _ in docs} <= expected


def test_lcs_in_bits():
    dice = random.Random(1)
    for _ in range(200):
        a, b = ([dice.randrange(5) for _ in range(dice.randint(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.lcs_length(decontaminate._masks(a), len(a), b) == table[-1][-1]


def test_latent_space_is_the_svd(spark):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = decontaminate._item_passages(bench, "item_id", "text")
    rows = [np.array(r["words"], np.int64).view(np.uint64) for r in items.collect()]
    terms = decontaminate.Terms(np.unique(np.concatenate(rows)))
    idf = np.linspace(1, 3, terms.size)
    matrix = np.zeros((len(rows), terms.size))
    for i, row in enumerate(rows):
        np.add.at(matrix[i], terms.dimensions(row), idf[terms.dimensions(row)])
        matrix[i] /= np.linalg.norm(matrix[i])
    space = decontaminate.latent_space(items, terms, idf)
    exact = np.linalg.svd(matrix, full_matrices=False)[2]
    assert space.shape[1] == min(len(rows), decontaminate.RANK)
    assert np.allclose(np.linalg.svd(exact @ space, compute_uv=False), 1, atol=1e-3)


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><div id="cookie-notice">Cookies</div><nav><ul><li><a href="/a">A</a><li>B</ul></nav>
<main><article><header><h1>Title %(n)s</h1><p>by someone</p></header><p>First <b>bold</b>  &amp;\n more %(n)s<p>Second&nbsp;x
%(extra)s<div class="ad-slot">Buy</div><form>Name <input> <button>Send</button></form><script>if (a < b) "</p>"</script>
<section class="comments"><p>Nice!</p></section></article></main><aside>Side</aside><footer>&copy; foot</footer>"""


def test_pages_of_a_host(spark):
    lists = ["", "<ul><li>one<li>two</ul>", "<p>Third</p><p>Fourth</p>", "<ul><li>only</ul><h2>Head</h2><p>x"]
    pages = [(i, f"https://a.example/{i}", PAGE % {"n": i, "extra": lists[i % 4]}) for i in range(12)]
    pages += [(90, "https://b.example/", None), (91, None, "<p>free</p>"), (92, "no url", ""), (93, "https://a.example/x", "")]
    pages += [(94, "https://c.example/", "a < b &lt;p&gt; <3 &#65;"), (95, "https://c.example/1", "<p>un<b>closed")]
    table = odd_documents(spark, []).drop("text")
    table = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "url AS host", "html AS wrapper", "url AS text")
    out = {r["page_id"]: r["text"] for r in html_extract.extract_main_text(table).collect()}
    tails = ["", "\none\ntwo", "\nThird\nFourth", "\nonly\nHead\nx"]
    for i in range(12):
        assert out[i] == f"Title {i}\nFirst bold & more {i}\nSecond x" + tails[i % 4]
    assert out[90] == out[92] == out[93] == ""
    assert out[91] == "free" and out[94] == "a < b <p> <3 A" and out[95] == "unclosed"


def test_pages_against_their_articles(spark):
    """All pages of the smallest table: what lies between the article's tags."""
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    import html as library

    expected = {}
    for r in rows.collect():
        article = r["html"].split("<article>")[1].split("</article>")[0]
        blocks = re.split(r"</?(?:p|h1)>", article)
        texts = (" ".join(library.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks)
        expected[r["page_id"]] = "\n".join(t for t in texts if t)
    assert {r["page_id"]: r["text"] for r in html_extract.extract_main_text(rows).collect()} == expected


def test_wrapper_without_named_elements():
    pages = [f"<p>Welcome</p><h2>T{i}</h2><p>text {i}</p><div>same foot</div>" for i in range(4)]
    wrapper = None
    for page in pages:
        found = html_extract.folded(parse(page)[0])
        wrapper = html_extract._join(wrapper, found)
    assign_roles(wrapper)
    found, texts = parse(pages[2])
    assert [texts[i] for i in main_texts(Node.unpack(wrapper.pack()), found)] == ["T2", "text 2"]
    assert shape(found) == "page(p(#)h2(#)p(#)div(#))"


def extracted(pages):
    """Main texts of one host's pages, by wrappers alone."""
    wrapper = None
    for page in pages:
        wrapper = html_extract._join(wrapper, html_extract.folded(parse(page)[0]))
    out = []
    for page in pages:
        found, texts = parse(page)
        out.append([texts[i] for i in main_texts(Node.unpack(wrapper.pack()), found)])
    return out


def _without_wrapper(page):
    found, texts = parse(page)
    return [texts[i] for i in main_texts(Node("page", []), found)]


def _some(dice, n):
    return " ".join("".join(dice.choices("abcdefg", k=5)) for _ in range(n))


def test_what_varies_across_pages_is_the_main_text():
    """Nothing is named: only the other pages of the host tell the article from what is around it."""
    dice = random.Random(7)
    pages, wanted = [], []
    for i in range(40):
        own = [_some(dice, 4), *(_some(dice, 25) for _ in range(dice.randint(2, 5)))]
        blocks = f"<h1>{own[0]}</h1>" + "".join(f"<p>{t}</p>" for t in own[1:])
        rail = '<div class="rail"><a href=x>Home</a><ul><li>News<li>Sport</ul></div>'
        pages.append(f'<body>{rail}<div class="col">{blocks}</div><div class="bottom">Page {i}</div></body>')
        wanted.append(own)
    assert extracted(pages) == wanted
    assert all(_without_wrapper(p) != w for p, w in zip(pages, wanted))


def test_fixed_lines_of_like_boxes_are_out():
    dice = random.Random(8)
    own = [[_some(dice, 3), _some(dice, 30)] for _ in range(10)]
    pages = [
        f'<div class="page"><div class="c1"><p>Site menu home</p><p>All rights</p></div><div class="c2"><h2>{h}</h2><p>{t}</p></div></div>'
        for h, t in own
    ]
    assert extracted(pages) == own and _without_wrapper(pages[0]) != own[0]


def test_names_that_only_contain_a_word_do_not_decide():
    """In an article, what varies stays whatever it is called; what never varies and is called so goes."""
    dice = random.Random(9)
    own = [[_some(dice, n) for n in (4, 20, 15, 30)] for _ in range(5)]
    pages = [
        f'<article><h1>{a}</h1><div class="social-policy"><p>{b}</p></div><p class="legal-text">{c}</p><p>{d}</p>'
        f'<div class="share-buttons">Share {i}</div><p class="legal-line">All rights</p></article>'
        for i, (a, b, c, d) in enumerate(own)
    ]
    assert extracted(pages) == own and _without_wrapper(pages[0]) != own[0]


def test_long_unlike_pages_are_aligned_in_their_length(monkeypatch):
    def page(k):
        names = ("".join(chr(97 + (i * 7 + k * j) % 26) for j in (1, 2)) for i in range(3000))
        return "<article>" + "".join(f'<div class="k{n}"><p>{k} {i}</p></div>' for i, n in enumerate(names)) + "</article>"

    from sheetloom.llm import wrapper

    pages = [page(1), page(3)]
    assert [len(t) for t in extracted(pages)] == [3000, 3000]
    short = [p[:4000] for p in pages]
    exact = extracted(short)
    monkeypatch.setattr(wrapper._pairs, "__defaults__", (0,))
    assert extracted(short) == exact


def test_mixed_layouts_keep_their_texts():
    """Blocks of an article in any order: what folds into groups must still be found."""
    dice = random.Random(2)
    block = {
        "p": lambda t: (f"<p>{t}</p>", [t]),
        "ul": lambda t: (f"<ul><li>{t}a</li><li>{t}b</li></ul>", [f"{t}a", f"{t}b"]),
        "h2": lambda t: (f"<h2>{t}</h2>", [t]),
        "table": lambda t: (f"<table><tr><td>{t}a</td><td>{t}b</td></tr></table>", [f"{t}a", f"{t}b"]),
    }
    for layouts in [[["p", "ul", "p"], ["ul", "p", "ul"]]] + [
        [dice.choices(list(block), k=dice.randint(1, 9)) for _ in range(dice.randint(2, 12))] for _ in range(60)
    ]:
        made = [[block[kind](f"t{i}.{j}") for j, kind in enumerate(layout)] for i, layout in enumerate(layouts)]
        pages = [f"<nav><p>menu</p></nav><article>{''.join(m for m, _ in page)}</article><footer>foot</footer>" for page in made]
        assert extracted(pages) == [[t for _, texts in page for t in texts] for page in made]


def test_templates_of_a_host(spark):
    """Each page gets the main text of its own template, also among pages without a host."""
    nav = "<nav><p>menu</p></nav>"
    templates = [
        lambda t: f"{nav}<article><p>{t}</p></article><footer>foot</footer>",
        lambda t: f'{nav}<div class="content"><p>{t}</p></div><footer>foot</footer>',
        lambda t: f'{nav}<section id="story"><h2>{t}</h2></section><footer>foot</footer>',
        lambda t: f"{nav}<main><p>{t}</p></main>",
        lambda t: f"{nav}<main><article><p>{t}</p></article></main>",
        lambda t: f"{nav}<p>{t}</p><footer>foot</footer>",
    ]
    texts = {i: f"text {i} " + "long " * (i % 5) for i in range(120)}
    urls = {"host": "https://a.example/x", "relative": "/x", "null": None}
    for chosen in ([0, 5], [1, 2], [3, 4], [0, 1, 2, 3, 4, 5]):
        made = [templates[chosen[i % len(chosen)]](t) for i, t in texts.items()]
        assert extracted(made) == [[t.strip()] for t in texts.values()]
    pages = [(f"{name} {i}", url, templates[i % 6](t)) for name, url in urls.items() for i, t in texts.items()]
    rows = html_extract.extract_main_text(spark.createDataFrame(pages, "page_id string, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in rows} == {f"{name} {i}": t.strip() for name in urls for i, t in texts.items()}


def test_deep_pages(spark):
    """Thousands of tags that are never closed, next to a usual page of the host."""
    deep = ["<div>", "<ul><li>", "<blockquote><p>", "<table><tr><td>", '<div class="comment">', "<nav>", "<section>x"]
    pages = [(0, "https://a.example/", "<article><p>usual</p></article>")]
    pages += [(i, "https://a.example/", f"<article><p>text {i}</p>{tags * 3000}<b>end") for i, tags in enumerate(deep, 1)]
    pages += [(20 + i, None, f"{tags * 3000}<p>alone") for i, tags in enumerate(deep)]
    rows = html_extract.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    out = {r["page_id"]: r["text"] for r in rows}
    assert len(out) == len(pages) and out[0] == "usual"
    for i, tags in enumerate(deep, 1):
        kept = ["x"] * 3000 if "x" in tags else []
        kept += [] if "nav" in tags or "comment" in tags else ["end"]
        assert "".join(out[i].split("\n")) == f"text {i}" + "".join(kept)
    assert out[20] == out[21] == "alone" and out[24] == out[25] == ""


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_feistel_permutes(n):
    order = token_shards.Feistel(n, 7)
    slots = order.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (order.indexes(slots) == np.arange(n)).all()
    assert n < 64 or (slots != token_shards.Feistel(n, 8).slots(np.arange(n))).any()


def test_shards_round_trip(spark):
    folder = token_shards.new_folder(spark)
    docs = odd_documents(spark)
    manifest = token_shards.write_training_order(docs, folder, length=128, shard_size=50)
    rows = sorted(manifest.collect(), key=lambda r: r["sequence"])
    read = {r["slot"]: r["ids"] for r in token_shards.read_training_order(spark, folder).collect()}
    assert sorted(read) == sorted(r["slot"] for r in rows) == list(range(len(rows)))
    bpe, texts, open_text = Bpe(vocabulary_path()), [], []
    for r in rows:
        ids = read[r["slot"]]
        assert hashlib.sha256(np.array(ids, "<u2").tobytes()).hexdigest() == r["sha256"]
        assert (r["shard"], r["byte_offset"]) == (r["slot"] // 50, r["slot"] % 50 * 256)
        for i in ids[: r["n_tokens"]]:
            if i == bpe.size:
                texts.append(bpe.decode(open_text))
                open_text = []
            else:
                open_text.append(i)
    assert sorted(texts) == sorted(r[1] or "" for r in odd_rows()) and not open_text
    assert {i for r in rows for i in r["doc_ids"]} == {r[0] for r in odd_rows()}
    later = token_shards.read_training_order(spark, folder, 77).collect()
    assert {r["slot"]: r["ids"] for r in later} == {s: v for s, v in read.items() if s >= 77}
