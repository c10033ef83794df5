"""Each operator against brute force or held-out rows, and on awkward rows."""

from __future__ import annotations

import re

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from aqlake.llm import html_text, language, neighbours, packing, quality, simhash, url_filter
from aqlake.llm.decontaminate import decontaminate, decontaminate_digest
from aqlake.llm import license_scan as license_scan_module
from aqlake.llm.license_scan import license_scan
from aqlake.llm.line_dedup import dedup_lines

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, sequence_id string, fp string"
WORDS = "river hill stone water mill field boat carry slow green north wind over under bridge road".split()


def prose(seed: int, n: int) -> str:
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


def documents(spark, texts):
    rows = [(i, t, "en", "s", 0, 9.0, "x", "y") for i, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


ODD = [(1, None), (2, ""), (3, "\n \t"), (4, "one"), (5, prose(1, 60)), (5, prose(1, 60)), (6, prose(1, 60)), (7, "Ä ß 日本 \U0001f600 " * 40), (None, "lost"), (8, prose(2, 30_000))]


def test_simhash_matches_brute_force(spark):
    base = prose(3, 400)
    near = [(100 + i, base.replace("river", "creek", 1) + " end" * (i % 3)) for i in range(40)]
    rows = [(i, t) for i, t in ODD if i is not None] + near + [(200 + i, prose(50 + i, 40)) for i in range(60)]
    got = simhash.simhash_digest(documents(spark, rows)).collect()
    assert len(got) == len(rows)

    def slow(text):
        words = [w for w in (text or "").encode().lower().replace(b"\t", b" ").replace(b"\n", b" ").split(b" ") if w]
        h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0

    fps = [(i, slow(t)) for i, t in rows]
    root = {f: f for _, f in fps}
    changed = True
    while changed:
        changed = False
        for a in root:
            for b in root:
                if (a ^ b).bit_count() <= 2 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    least = {}
    for i, f in fps:
        least[root[f]] = min(i, least.get(root[f], i))
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        (i, f"{f:016x}", least[root[f]]) for i, f in fps
    )


@pytest.mark.parametrize("n", [2, 63, 65, 300])
@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_distances_are_exact(n, radius):
    rng = np.random.default_rng(n)
    values = rng.integers(0, 2**63, 1, np.uint64) ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    values = np.unique(values ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)))
    truth = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
    np.fill_diagonal(truth, False)
    assert (simhash.close(values, radius) == truth).all()


def test_a_split_bucket_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 4)
    chain = [0]
    for b in range(40):
        chain.append(chain[-1] ^ (1 << b) ^ (1 << (b + 20)))
    fps = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in chain], "fp bigint")
    links = simhash.fingerprint_links(fps, 2)
    from aqlake.llm.shared import components

    assert components(links).select("root").distinct().count() == 1


def test_packing_round_trip(spark):
    rows = [*ODD, *((20 + i, prose(i, 20 + 37 * i)) for i in range(60))]
    got = packing.packing_digest(documents(spark, rows)).toPandas()
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*coder.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    expected = sorted(
        (str(i), s // 2048, s, len(ids[i][s : s + 2048]), zlib.crc32(np.array(ids[i][s : s + 2048], "<u4").tobytes()))
        for i, _ in rows
        for s in range(0, len(ids[i]), 2048)
    )
    name = lambda x: "None" if x is None or x != x else str(int(x))
    assert sorted((name(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()) == expected
    for _, bin_ in got.groupby("sequence_id"):
        bin_ = bin_.sort_values("offset")
        assert (bin_.offset.to_numpy() == np.concatenate([[0], bin_.length.cumsum()[:-1]])).all()
        assert bin_.length.sum() <= 2048
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 2048) + 1


def test_words_coded_once_give_the_ids_of_the_whole_text():
    import random

    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    marks = [*map(chr, range(0x300)), *"\u0301\u0345\u03a3\u3000\u2019\u0663\uac00\u200d\u1100\u1161\ufeff\u212a"]
    marks += ["<|startoftext|>", "<|endoftext|>", "'ll", "'RE", "'s", "\U0001f600", *"  aabbccAI.'"] * 8
    dice = random.Random(1)
    texts = ["".join(dice.choices(marks, k=dice.randrange(40))) for _ in range(20000)] + ["", " ", "\n", "a" * 20000]
    for a, b in zip(packing._ids_by_word(path)(texts), packing._ids_by_text(path)(texts)):
        assert a.tolist() == b.tolist()


def test_packing_holds_every_capacity():
    lengths = np.array([5, 5, 4, 4, 3, 3, 2, 2, 1, 1])
    bins, offsets = packing.best_fit(lengths, np.array([10.0, 2.0, 41.0]), np.ones(3))
    for b in set(bins):
        inside = lengths[bins == b]
        assert inside.sum() <= 10 and len(inside) <= 2 and (inside**2).sum() <= 41


def test_quality_held_out(spark, sf_dir="/root/testdata/sf0.01"):
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    got = quality.quality_digest(read("documents"), read("labels")).join(read("labels"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.9
    assert got.score.between(0, 1).all()


def test_quality_of_odd_rows_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = quality.quality_digest(documents(spark, ODD), none).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)


def test_language_held_out(spark, sf_dir="/root/testdata/sf0.01"):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = language.language_digest(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held_out = got[got.held_out]
    assert (held_out.lang_pred == held_out.lang).mean() > 0.95
    assert abs(held_out.score.mean() - (held_out.lang_pred == held_out.lang).mean()) < 0.03


def test_texts_of_unknown_languages_are_rejected(spark, sf_dir="/root/testdata/sf0.01"):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    unknown = docs.groupBy("lang").count().where("lang IS NOT NULL").orderBy("count").first().lang
    models = language.fit_languages(docs.where(F.col("lang") != unknown))
    got = language.identify(docs.where("lang IS NOT NULL"), models).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert got[got.lang == unknown].rejected.mean() > 0.9 and got[got.lang != unknown].rejected.mean() < 0.02
    others = documents(spark, [(1, "これは日本語の文章です"), (2, "Это предложение на русском языке"), (3, "xqzv kjwq zzxq vvkq")])
    assert all(r.rejected and r.score < 0.5 for r in language.identify(others, models).collect())


def test_languages_of_few_texts_keep_them(spark):
    rows = [(i, f"word number{i} und{i} text", "en") for i in range(200)] + [(900, "ein einziger satz", "de")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    models = language.fit_languages(docs)
    assert models.langs == ["de", "en"]
    assert models.predict(["ein einziger satz"])[0] == ["de"]


def test_kneser_ney_sums_to_one(spark):
    docs = documents(spark, [(1, "abca bcab cabb"), (2, "aabb ccab"), (3, None)])
    model = language.LanguageModels(language.kneser_ney(language.gram_counts(docs)).toPandas())
    units = np.arange(language.ALPHABET, dtype=np.uint64)
    for history in ("abc", " ab", "zzz"):
        head = np.uint64(0)
        for c in history:
            head = (head << np.uint64(16)) | np.uint64(ord(c))
        assert abs((2.0 ** -model.bits((head << np.uint64(16)) | units)).sum() - 1) < 1e-3


def test_language_models_keep_every_entry_in_any_number_of_pieces(spark, monkeypatch):
    rng = np.random.default_rng(4)
    texts = ["".join(chr(0x4E00 + c) for c in rng.integers(0, 3000, 3000)) for _ in range(8)]
    docs = documents(spark, list(enumerate(texts)))
    table = language.kneser_ney(language.gram_counts(docs)).toPandas()
    seen = {int(g) for t in texts for g in language.grams(language.letters(t))}
    wanted = {(k, g & ((1 << 16 * k) - 1)) for g in seen for k in range(1, 5)}
    wanted |= {(-k, (g & ((1 << 16 * k) - 1)) >> 16) for g in seen for k in range(1, 5)}
    assert {(s, g & (1 << 64) - 1) for s, g in zip(table["size"].tolist(), table["gram"].tolist())} == wanted
    assert len(table) == len(wanted)

    monkeypatch.setattr(language, "PIECE", 5000)
    pieces = language._pieces(language.kneser_ney(language.gram_counts(docs)))
    assert len(pieces["en"]) >= 16
    asked = np.concatenate([np.array(sorted(seen), np.uint64), rng.integers(0, 1 << 62, 500).astype(np.uint64)])
    assert np.array_equal(language.LanguageModels(pieces=pieces).bits(asked), language.LanguageModels(table).bits(asked))
    got = language.language_digest(docs).collect()
    assert len(got) == 8 and {r.lang_pred for r in got} == {"en"}


def test_language_of_odd_rows(spark):
    got = {r.doc_id: r.lang_pred for r in language.language_digest(documents(spark, ODD)).collect()}
    assert [got[i] for i in (1, 2, 3)] == ["und"] * 3 and got[5] == "en" and len(got) == 9


def test_neighbours_recall_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist(), 0) for i in range(1500)]
    rows += [(2000 + i, [1.0] * 8, 0) for i in range(200)]  # equal vectors
    rows += [(5000, None, 0), (5050, [0.0] * 8, 0), (5100, [float("nan")] * 8, 0), (5150, [None] * 8, 0), (5200, [], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score int").repartition(4)
    got = neighbours.neighbours_digest(df).toPandas()
    m = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if i < 5000}
    ids = np.array(list(m))
    unit = np.stack([v / np.linalg.norm(v) for v in m.values()])
    hit = 0
    for q in (asked := [i for i in ids if i % 50 == 0]):
        score = np.round(unit @ unit[list(ids).index(q)], 12)
        score[list(ids).index(q)] = -9
        hit += len(set(ids[np.lexsort((ids, -score))[:5]]) & set(got[got.query_id == q].vec_id))
    assert hit / (5 * len(asked)) >= 0.9
    assert set(got.query_id) == set(asked)
    assert got[got.query_id == 2050].sort_values("rank").vec_id.tolist() == [2000, 2001, 2002, 2003, 2004]


def test_url_parts_and_rules(spark):
    cases = [
        (1, None), (2, ""), (3, "no-scheme.org/fr/"), (4, "HTTP://A.Example.COM/de/1?x#y"), (5, "http://x.net"),
        (6, "http://example.net/en/1"), (7, "http://planet/x"), (8, "http://a.net/#/en/"), (9, "http://org/fr/é"), (9, "http://org/fr/é"),
    ]
    df = spark.createDataFrame([(*c, "h", "p") for c in cases], "page_id int, url string, host string, rule string")
    got = [tuple(r) for r in url_filter.url_digest(df).orderBy("page_id").collect()]
    assert got == [
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "a.example.com", "/de/1", "example.com/de/", "block"), (5, "x.net", "", None, "allow"),
        (6, "example.net", "/en/1", "example.net/en/", "allow"), (7, "planet", "/x", None, "allow"),
        (8, "a.net", "/", "net/", "block"), (9, "org", "/fr/é", "org/fr/", "allow"), (9, "org", "/fr/é", "org/fr/", "allow"),
    ]


def test_url_templates_reject_by_purity(spark):
    urls = [f"http://shop/item/{i}/x" for i in range(40)] + [f"http://shop/news/{i}/x" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    rules = [("block", f"shop/item/{i}/") for i in range(30)] + [("allow", f"shop/news/{i}/") for i in range(30)]
    got = {r.url: (r.rule, r.verdict) for r in url_filter.judge_urls(df, rules).collect()}
    assert got["http://shop/item/39/x"] == (None, "block") and got["http://shop/news/39/x"] == (None, "allow")


def test_url_verdicts_do_not_change_with_copies_or_pages_of_an_id(spark):
    rules = [("block", "h.example.com/de/"), *(("block", f"few/a/{i}") for i in range(7)), ("block", "g/user1/")]
    urls = [f"http://h.example.com/de/{i}" for i in range(20)] + [f"http://h.example.com/a{i}/{i}" for i in range(30)]
    urls += [f"http://few/a/{i}" for i in range(9)]
    # ten pages of each id
    urls += [f"http://g/user{i}/p{j}" for i in range(30) for j in range(10)]
    verdicts = []
    for times in (1, 3):
        df = spark.createDataFrame(list(enumerate(urls * times)), "page_id int, url string")
        rows = url_filter.judge_urls(df, rules).collect()
        assert len(rows) == len(urls) * times
        verdicts.append({(r.url, r.verdict, r.template) for r in rows})
    assert len(verdicts[0]) == len(urls) and verdicts[0] == verdicts[1]
    assert {v for u, v, _ in verdicts[0] if "h.example.com" in u} == {"block"}
    assert {t for u, _, t in verdicts[0] if "/user" in u} == {"/*/*"}


def test_url_templates_follow_paths_of_any_depth(spark):
    urls = [f"http://deep/a/b/c/{kind}/{i}/x{i}/end" for kind in ("story", "shop") for i in range(20)]
    urls += ["http://deep/a/b", "http://alone/" + "s/" * 40 + "s"]
    rules = [("block", f"deep/a/b/c/shop/{i}/") for i in range(15)] + [("allow", f"deep/a/b/c/story/{i}/") for i in range(15)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r.url: (r.verdict, r.template) for r in url_filter.judge_urls(df, rules).collect()}
    assert len(got) == len(urls)
    assert got["http://deep/a/b/c/shop/19/x19/end"] == ("block", "/*/*/*/shop/*/*/*")
    assert got["http://deep/a/b/c/story/19/x19/end"] == ("allow", "/*/*/*/story/*/*/*")
    assert got[urls[-2]][1] == "/*/*" and got[urls[-1]][1] == "/*" * 41


def templates_by_hand(rows):
    """{(host, path): template}, one level after the other; rows: (host, path, blocked, allowed)."""
    def purity(part):
        blocked, allowed = (sum(r[k] for r in part) for k in (2, 3))
        return (blocked + 1) / (blocked + allowed + 2), blocked + allowed + 2

    out, level = {}, 0
    now = [(*r, "", r[1].removeprefix("/").split("/")) for r in rows]
    while now:
        nodes, further = {}, []
        for r in now:
            nodes.setdefault((r[0], r[4]), {}).setdefault(r[5][level], []).append(r)
        for kinds in nodes.values():
            every = [r for part in kinds.values() for r in part]
            p = purity(every)[0]
            values = sum(any(c in "0123456789" for c in s) or len(part) <= 2 for s, part in kinds.items())
            for segment, part in kinds.items():
                q, n = purity(part)
                star = (len(kinds) >= 8 and 2 * values >= len(kinds)) or abs(q - p) <= (p * (1 - p) / n) ** 0.5
                for r in part:
                    template, left = f"{r[4]}/{'*' if star else segment}", len(r[5]) - level - 1
                    if len(every) == 1 or not left:
                        out[r[0], r[1]] = template + "/*" * left
                    else:
                        further.append((*r[:4], template, r[5]))
        now, level = further, level + 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_url_templates_equal_those_made_level_by_level(spark, seed):
    rng = np.random.default_rng(seed)
    paths = {"/", "", "/a", "/a/", "/a//b", "/1/2/3"}
    for _ in range(300):
        parts = [str(rng.choice(["a", "b", "c", "de", "en", str(rng.integers(40))])) for _ in range(rng.integers(1, 7))]
        paths.add("/" + "/".join(parts[: rng.integers(1, 7)]))
        paths.add("/x/y/z/" + "/".join(parts))
    rows = [(f"h{rng.integers(3)}", p, *((1, 0) if (mark := rng.random()) < 0.3 + 0.4 * ("/de" in p) else (0, int(mark > 0.8)))) for p in sorted(paths)]
    df = spark.createDataFrame([(h, p, 1, b, a) for h, p, b, a in rows], "host string, path string, n long, blocked long, allowed long")
    got = {(r.host, r.path): r.template for r in url_filter.templates(df).collect()}
    assert got == templates_by_hand(rows)


def test_url_templates_pass_shared_segments_in_one_step(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(url_filter, "_past_shared", lambda df, plain=url_filter._past_shared: steps.append(1) or plain(df))
    trap = ["/".join(["", *["next"] * k]) for k in range(1, 300)]  # each path the start of the one after it
    paths = [*trap, "/" + "s/" * 500 + "1", "/" + "s/" * 500 + "2"]
    df = spark.createDataFrame([("trap" if "n" in p else "deep", p, 1, 0, 0) for p in paths], "host string, path string, n long, blocked long, allowed long")
    got = {r.path: r.template for r in url_filter.templates(df).collect()}
    assert got == {p: "/*" * p.count("/") for p in paths} and len(steps) <= 2


PAGE = (
    "<html><head><title>T</title><script>var a='<p>';</script></head><body><nav><a href=/>Home</a></nav>"
    "<div class='cookie-notice'>We use cookies</div><article><h1>Rivers &amp; hills</h1><p><b>Water runs\n from the hills,"
    " and it turns the mill.<br><p>It reaches the sea in the north, slow and green, under the bridge.</p></article>"
    "<section id=comments><p>Nice!</p></section><form><label>Mail</label></form><footer>&copy; x</footer>"
)


def test_html_text(spark):
    rows = [(1, "u", PAGE, "t"), (2, None, None, "t"), (3, "u", "", "t"), (4, "u", "<script>x</script><!-- c -->", "t"), (5, "u", PAGE, "t")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string").repartition(2)
    got = {r.page_id: r for r in html_text.extraction_digest(pages).collect()}
    text = "Rivers & hills\nWater runs from the hills, and it turns the mill.\nIt reaches the sea in the north, slow and green, under the bridge."
    assert [got[i].text for i in range(1, 6)] == [text, "", "", "", text] and got[1].n_chars == len(text)


def test_html_without_end_tags_loses_no_text():
    def text(html):
        every = html_text.nodes_of(html_text.parse(html))
        return html_text.blocks_of(every, set(range(len(every))))

    article = "<article><p>Water runs.</p><p>It turns the mill.</p></article>"
    wanted = "Water runs.\nIt turns the mill."
    assert text(f"<head><title>t</title><meta charset=utf-8>{article}") == wanted
    assert text(f"<html><head><title>t</title><style>p {{}}</style></head><body>{article}") == wanted
    for tag in ("button", "select", "iframe", "textarea", "svg", "template", "title"):
        assert text(f"<div><{tag}>Menu{article}<{tag}>More</{tag}></div>") == wanted, tag
        assert text(f"<div><{tag}>Menu</div>{article}") == wanted, tag
        assert text(f"<div><span><{tag}>Menu</span> then</div>{article}") == f"then\n{wanted}", tag
        assert text(f"<{tag}><p>Menu</p></{tag}>{article}") == wanted, tag
    assert text(f"<noscript><p>Plain</p></noscript><object>Fallback</object>{article}") == f"Plain\nFallback\n{wanted}"
    assert text("<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>") == "So x=2 holds"
    assert text(f"{article}<script>if (a < b) '<p>no'") == wanted
    assert text(f"<textarea></div></textarea>{article}<div><button>a<b>b</button></div>") == wanted


def test_html_decoding_never_keeps_below_dropped():
    root = html_text.parse("<div><div><p>a</p></div><p>b</p></div>" + "<div>" * 3000 + "deep")
    nodes = html_text.nodes_of(root)
    margins = np.random.default_rng(0).normal(size=len(nodes))
    kept = html_text.decode(nodes, margins)
    place = {id(n): i for i, n in enumerate(nodes)}
    assert all(i == 0 or place[id(nodes[i].parent)] in kept for i in kept)


def test_boosted_trees_learn_an_interaction():
    x = np.random.default_rng(0).normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    assert ((html_text.Boosted().fit(x, y).margin(x) > 0) == (y > 0)).mean() > 0.95


def test_line_dedup_of_odd_rows(spark):
    common = "This line stands in many documents."
    rows = [*ODD, *((30 + i, f"{common}\nown {i}") for i in range(4))]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in dedup_lines(documents(spark, rows)).collect()}
    assert got[1] == (1, 0, "") and got[30] == (2, 1, "own 0") and got[33] == (2, 0, f"{common}\nown 3")


def test_decontamination_of_odd_rows(spark):
    passage = prose(9, 20)
    items = spark.createDataFrame([(1, passage), (2, None), (3, "")], "item_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate(documents(spark, [*ODD, (40, f"a {passage.upper()} b")]), items).collect()}
    assert got[40].contaminated and got[40].n_hit == 20 and got[1].n_words == 0 and not got[1].contaminated
    assert decontaminate_digest(documents(spark, ODD), items.limit(0)).count() == len(ODD)


def test_license_scan(spark):
    rows = [*ODD, (50, f"{prose(4, 30)} Released under the MIT License. {prose(5, 9)}")]
    assert [(r.doc_id, r.license_id, r.containment) for r in license_scan(documents(spark, rows)).collect()] == [(50, "mit", 1.0)]


def test_only_documents_with_a_shingle_of_a_long_notice_have_windows(spark, monkeypatch):
    words = license_scan_module.NOTICES["mit-text"].split()
    rows = [(1, prose(1, 60)), (2, f"{prose(2, 40)} {' '.join(words[10:16])}"), (3, " ".join(words)), (3, prose(3, 20)), (None, " ".join(words)), (4, "")]
    frames, shingles = [], license_scan_module._with_shingles
    monkeypatch.setattr(license_scan_module, "_with_shingles", lambda found, sizes: frames.append((found, sizes)) or shingles(found, sizes))
    got = license_scan(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.license_id, r.containment) for r in got) == [("3", "mit-text", 1.0), ("None", "mit-text", 1.0)]
    windowed = [found for found, sizes in frames if "doc_id" in found.columns and sizes == [license_scan_module.SHINGLE]]
    assert len(windowed) == 1 and sorted(str(r.doc_id) for r in windowed[0].collect()) == ["2", "3", "3", "None"]


def test_long_notices_are_found_as_by_brute_force(spark):
    rng = np.random.default_rng(8)
    long = {i: re.findall("[a-z0-9]+", license_scan_module.NOTICES[i].lower()) for i in ("apache-2.0-header", "mit-text")}
    shingles = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    rows, wanted = [], {}
    for i, words in enumerate(long.values()):
        for edits in (0, 1, 2, 3, 5) * 3:
            copy = list(words)
            for at in rng.choice(len(copy), edits, replace=False):
                copy[at] = "edited"
            text = prose(len(rows), int(rng.integers(0, 40))).split() + copy + prose(900 + len(rows), 30).split()
            rows.append((len(rows), " ".join(text)))
            held = shingles(text)
            for name, own in long.items():
                own = set(shingles(own))
                reach = len(own) + -(-len(own) // 4)
                share = max(len(own & set(held[k : k + reach])) for k in range(len(held))) / len(own)
                if share >= 0.8:
                    wanted[rows[-1][0], name] = round(share, 9)
    got = {(r.doc_id, r.license_id): round(r.containment, 9) for r in license_scan(documents(spark, rows)).collect()}
    assert {k: v for k, v in got.items() if k[1] in long} == wanted and 12 <= len(wanted) < len(rows)


def test_empty_tables(spark):
    docs = documents(spark, ODD).limit(0)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    for made in (
        simhash.simhash_digest(docs), quality.quality_digest(docs, labels), language.language_digest(docs), packing.packing_digest(docs),
        neighbours.neighbours_digest(vectors), url_filter.url_digest(pages), html_text.extraction_digest(pages), license_scan(docs),
        dedup_lines(docs),
    ):
        assert made.count() == 0


def test_large_ids_beside_a_null_id(spark):
    big = 2**53 + 1
    texts = [(big, prose(1, 40)), (None, prose(2, 40)), (big + 1, prose(3, 40)), (-big, prose(4, 40))]
    docs = documents(spark, texts).coalesce(1)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(4)], "doc_id bigint, quality int, toxic int")
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a.b/").alias("url"), F.concat(F.lit("<p>"), "text").alias("html"))
    wanted = sorted((i for i, _ in texts), key=str)
    for made in (
        simhash.simhash_digest(docs), quality.quality_digest(docs, labels), language.language_digest(docs), packing.packing_digest(docs),
        html_text.extraction_digest(pages).withColumnRenamed("page_id", "doc_id"),
    ):
        assert sorted((r.doc_id for r in made.collect()), key=str) == wanted


def test_equal_rows_are_dealt_to_all_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    cut = spark.range(400).select(
        F.lit(7).cast("bigint").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("start"),
        F.lit(500).cast("bigint").alias("length"), F.lit(1).cast("bigint").alias("ids_crc32"),
    )
    rows = packing.pack(cut).collect()
    assert len({r.sequence_id >> 24 for r in rows}) == 8 and len(rows) == 400
    assert len({(r.sequence_id, r.offset) for r in rows}) == 400


def test_any_text_can_be_parsed():
    rng = np.random.default_rng(11)
    bits = ["<![foo[", "<![CDATA[", "]]>", "<!", "<!--", "-->", "<?", "</", "<p>", "</p>", "<article", ">", "<table><tr>", "</div", "&", "&#x", "&amp;", "<![if !IE]>",
            "<script>", "<li>", "a b", "\x00", "=\"", "'", "<br/>", "<x1><x2>", "</x2>", "日本", "\ud800"]
    for seed in range(400):
        page = "".join(rng.choice(bits, int(rng.integers(1, 60))))
        assert html_text.nodes_of(html_text.parse(page))
    nodes = html_text.nodes_of(html_text.parse("<article><p>a <![foo[bar]]> b</p></article>"))
    assert html_text.blocks_of(nodes, set(range(len(nodes)))) == "a b"
