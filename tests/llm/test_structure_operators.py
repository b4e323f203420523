"""Pages, packing, transcripts and the pipeline."""

import random
import re
from collections import Counter
from html import unescape

import brute
import pytest
from hard_rows import SF_DIR, empty, hard  # noqa: F401

import corpus_pipeline
from occrisk.llm import op6_html, op8_packing, op9_chat, op10_decontamination


def _article(html):
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = [" ".join(unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


def test_pages(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    got = op6_html.query(spark, SF_DIR).collect()
    assert len(got) == len(pages)
    for r in got:
        want = _article(pages[r["page_id"]]["html"])
        assert (r["url"], r["text"], r["n_chars"]) == (pages[r["page_id"]]["url"], want, len(want))


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="page-with-sidebar">
<header><a href=/>Site</a></header><nav><ul><li>Home<li>News</ul></nav>
<div id="cookieNotice">We use cookies</div><!-- <p>not this</p> --><script>var a = "</p><p>nor this";</script>
{body}
<aside>More</aside><section class="comments"><h2>Comments</h2><p>First!</p></section><form><label>Mail</label></form><footer>&copy; Site</footer></body></html>"""


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("<main><h1>A &amp; B</h1><p>x <b>y</b>z<br>w\n\n v<p>q</main>", "A & B\nx yz w v\nq"),
        ("<article><header><h1>Title</h1></header><ul><li>one<li>two <i>too</i></ul><div class='ad'>Buy</div><table><tr><td>1<td>2</table></article>", "Title\none\ntwo too\n1\n2"),
        ("<div><p>plain&nbsp;page &lt;b&gt; &#8364;</p>tail</div>", "plain page <b> €\ntail"),
        ("<article><p>open <b>bold<p>next</b> end", "open bold\nnext end"),
        (
            "<article><h1>T</h1><div class='share-price'>Ten</div><p class='notice-text'>Eleven</p><div id='comment-free'>Twelve</div><p><label>Thirteen</label></p>"
            "<div class='notice'>no</div><div class='x share'>no</div><form><label>no</label></form></article>",
            "T\nTen\nEleven\nTwelve\nThirteen",
        ),
        ("<div><header><h1>Title</h1></header><p>text</p></div><div><header>Site</header></div>", "Title\ntext"),
        ("<div hidden><p>no</p></div><p style='display: none'>no</p><p title='a > b'>yes</p>", "yes"),
        ("", ""),
    ],
)
def test_markup(body, want):
    assert op6_html.main_text(PAGE.replace("{body}", body)) == want


def test_site_templates_go_and_prose_stays(spark):
    """A box without a telling name recurs on a site; a sentence that recurs in articles is prose."""
    rows = []
    for n in range(12):
        box = "<div><p>Read our other papers too</p></div>"
        common = "<p>This sentence closes many articles.</p>" if n % 2 else ""
        rows.append((n, f"https://User@WWW.Site.example:80/{n}", f"<body>{box}<div><p>Page {n} is about thing {n}.</p></div></body>"))
        rows.append((100 + n, f"http://other.example/{n}", f"<body><article><p>Story {n}</p>{common}{box}</article></body>"))
    rows += [(200, "http://once.example/", "<body><div><p>Read our other papers too</p></div></body>"), (201, None, None), (202, "not a url", "<p>a<p>a"), (None, "", "")]
    rows += [(203, "http://once.example/", "")]
    got = {r["page_id"]: r["text"] for r in op6_html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert {got[n] for n in range(12)} == {f"Page {n} is about thing {n}." for n in range(12)}
    assert all(got[100 + n] == f"Story {n}" + ("\nThis sentence closes many articles." if n % 2 else "") for n in range(12))
    assert got[200] == "Read our other papers too" and got[201] == "" and got[202] == "a\na" and got[None] == ""
    assert op6_html.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def test_deep_and_broken_markup():
    deep = "<div>" * 5000 + "core" + "</span></div></p>" * 5000
    assert op6_html.main_text(deep) == "core"
    assert op6_html.template_candidates(deep)
    assert op6_html.main_text("a < b <!-- open <p>x") == "a < b"
    assert op6_html.main_text("<script>never closed <p>x") == ""


def _packed(pieces, longest):
    bins, docs = {}, {}
    for p in pieces:
        bins.setdefault((p["shard"], p["bin"]), []).append(p)
        docs.setdefault((p["doc_id"], p["copy"]), []).append(p)
    for content in bins.values():
        content.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in content] == [sum(q["n_tokens"] for q in content[:k]) for k in range(len(content))]
        used = sum(p["n_tokens"] for p in content)
        assert {(p["used"], p["capacity"]) for p in content} == {(used, min(c for c in op8_packing.LENGTHS if c >= used))}
    return {d: sorted((p["start"], p["n_tokens"]) for p in own) for d, own in docs.items()}


def test_packing(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    pieces = op8_packing.query(spark, SF_DIR).collect()
    got = _packed(pieces, max(op8_packing.LENGTHS))
    assert {d for d, _ in got} == set(docs)
    for (d, _), own in got.items():
        total = len(brute.SPACED.findall(docs[d] or "")) + 1
        assert [s for s, _ in own] == list(range(0, total, 4096)) and sum(n for _, n in own) == total
    used = {(p["shard"], p["bin"]): (p["used"], p["capacity"]) for p in pieces}.values()
    assert sum(u for u, _ in used) >= 0.95 * sum(c for _, c in used)


def test_packing_hard(spark, hard, empty, monkeypatch):
    monkeypatch.setattr(op8_packing, "SHARD_PIECES", 5)
    pieces = op8_packing.pack_documents(hard).collect()
    got = _packed(pieces, max(op8_packing.LENGTHS))
    want = Counter((r["doc_id"], len(brute.SPACED.findall(r["text"] or "")) + 1) for r in hard.collect())
    assert Counter((d, sum(n for _, n in own)) for (d, _), own in got.items() if d is not None and d != 5) == Counter({k: v for k, v in want.items() if k[0] not in (None, 5)})
    assert sum(p["n_tokens"] for p in pieces) == sum(n * k for (_, n), k in want.items())
    assert op8_packing.pack_documents(empty).collect() == []


def test_best_fit_beats_next_fit_and_shrinks():
    rng = random.Random(9)
    sizes = sorted((rng.randrange(1, 4097) for _ in range(3000)), reverse=True)
    places, capacities = op8_packing.pack(sizes)
    used = Counter()
    for b, s in zip(places, sizes):
        used[b] += s
    assert all(used[b] <= c and c == min(x for x in op8_packing.LENGTHS if x >= used[b]) for b, c in enumerate(capacities))
    assert sum(sizes) / sum(capacities) > 0.97
    assert op8_packing.pack([]) == ([], [])


def test_roles_on_held_out_conversations(spark):
    """Fit on some conversations, judge on the others."""
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    lines = op9_chat.with_features(op9_chat.transcripts(turns)).cache()
    model = op9_chat.fit(lines.where("conv_id % 3 != 0"))
    held = turns.where("conv_id % 3 = 0").collect()
    got = op9_chat.parse(lines.where("conv_id % 3 = 0").drop(*op9_chat.FEATURES), model).collect()
    begun = {(r["conv_id"], r["turn"]): r for r in got if r["line"] == 0}
    right = [t for t in held if (t["conv_id"], t["turn"]) in begun and begun[(t["conv_id"], t["turn"])]["role"] == t["role"]]
    assert len(right) >= 0.85 * len(held)
    assert sum(r["n_lines"] for r in got) == lines.where("conv_id % 3 = 0").count()
    exact = [t for t in right if begun[(t["conv_id"], t["turn"])]["text"] == f"<|{t['role']}|>\n{t['text']}\n<|end|>\n"]
    assert len(exact) >= 0.85 * len(right)


def test_long_and_hard_conversations(spark):
    rows = [(1, n, "user" if n % 2 == 0 else "assistant", f"Say {n}?" if n % 2 == 0 else f"It is {n}.\nAnd so on.") for n in range(300)]
    rows += [(1, 5, "assistant", "It is 5.\nAnd so on.")] * 3  # repeated rows are one turn
    rows += [(2, None, "user", "lost"), (None, 3, None, None), (None, 3, None, None), (3, 0, "tool", ""), (3, 1, None, None)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 as chunk", "'x' as line", "2 as tie")
    lines = op9_chat.with_features(op9_chat.transcripts(turns))
    out = op9_chat.parse(lines.drop(*op9_chat.FEATURES), op9_chat.fit(lines)).collect()
    assert sum(r["n_lines"] for r in out) == lines.count()
    long = sorted((r for r in out if r["conv_id"] == 1 and not r["continues"]), key=lambda r: (r["turn"], r["line"]))
    assert sum(r["role"] == ("user" if r["turn"] % 2 == 0 else "assistant") for r in long) >= 0.95 * 300
    assert sum(1 for r in out if r["conv_id"] is None) == 1
    none = turns.limit(0)
    lines = op9_chat.with_features(op9_chat.transcripts(none))
    assert op9_chat.parse(lines.drop(*op9_chat.FEATURES), op9_chat.fit(lines)).collect() == []


def test_pipeline(spark):
    """Every stage on what the one before kept, against plain versions."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "ngram_jaccard", "suffix_dedup", "decontamination", "packing"]

    docs = stages["quality_rules"](spark, docs, SF_DIR).cache()
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert 0 < len(kept) < len(texts) and all(kept[d] == texts[d] and not brute.quality(texts[d])[-1] for d in kept)

    columns = docs.columns
    docs = stages["ngram_jaccard"](spark, docs, SF_DIR).cache()
    assert docs.columns == columns
    want = {d for d, (c, _) in brute.jaccard(kept).items() if c == d}
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(kept) == want

    docs = stages["suffix_dedup"](spark, docs, SF_DIR).cache()
    assert docs.columns == columns
    after = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert after == {d: left.decode("utf-8", "ignore") for d, (*_, left) in zip(kept, brute.suffixes(list(kept.values()), 200))}

    leaks = {r["doc_id"] for r in op10_decontamination.leaks(docs, spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).collect()}
    docs = stages["decontamination"](spark, docs, SF_DIR).cache()
    assert docs.columns == columns and leaks
    assert {r["doc_id"] for r in docs.collect()} == set(after) - leaks

    pieces = stages["packing"](spark, docs, SF_DIR).collect()
    sizes = Counter()
    for p in pieces:
        sizes[p["doc_id"]] += p["n_tokens"]
    assert sizes == {d: len(brute.SPACED.findall(after[d])) + 1 for d in set(after) - leaks}
    assert Counter((r["doc_id"], r["start"], r["n_tokens"]) for r in corpus_pipeline.run(spark, SF_DIR).collect()) == Counter((p["doc_id"], p["start"], p["n_tokens"]) for p in pieces)


def _texts(spark, rows):
    return {r["page_id"]: r["text"] for r in op6_html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}


def test_menus_of_a_few_pages_of_a_large_site_go(spark):
    """A box on four of 60 pages is template; a notice that all articles have goes with it."""
    rows = []
    for n in range(60):
        box = "<div><ul><li>Rivers<li>Lakes</ul></div>" if n < 4 else ""
        rows.append((n, f"http://large.example/{n}", f"<body><article>{box}<p>Story {n}</p><p>All texts may be shared.</p></article></body>"))
        rows.append((100 + n, f"http://plain.example/{n}", f"<body>{box}<div><p>Page <b>{n % 9}</b> on thing {n}.</p></div></body>"))
    got = _texts(spark, rows)
    assert all(got[n] == f"Story {n}" and got[100 + n] == f"Page {n % 9} on thing {n}." for n in range(60))


def test_copies_of_a_page_are_one_page(spark):
    """Copies do not turn their own text into template, with and without an article."""
    rows = [(n, f"http://small.example/{n}", "<body><div><section><p>The same page.</p><ul><li>one</ul></section></div></body>") for n in range(5)]
    rows += [(10 + n, f"http://art.example/{n}", "<body><article><div><p>A copied story.</p></div></article></body>") for n in range(4)]
    rows += [(20, "http://art.example/x", "<body><article><p>Another story.</p></article></body>")]
    got = _texts(spark, rows)
    assert {got[n] for n in range(5)} == {"The same page.\none"} and {got[10 + n] for n in range(4)} == {"A copied story."} and got[20] == "Another story."
