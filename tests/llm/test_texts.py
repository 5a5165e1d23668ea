import base64
import hashlib
import random
from collections import defaultdict

import cases
import numpy as np
import public_tokenizers
import pytest

from lacuna.llm import bpe
from lacuna.llm.decontaminate import find_contaminated, remove_spans
from lacuna.llm.html_extract import extract_main_text, main_text
from lacuna.llm.quality import features, keep_quality, score_quality, train
from lacuna.llm.secrets import ALLOWED, CLASSES, Scanner, class_spans, find_secrets, windows_above
from lacuna.llm.token_counts import PieceCounter, count_tokens
from lacuna.llm.url_filter import Automaton, Rule, filter_urls, host_rule
from lacuna.llm.queries import URL_RULES

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTPS://WWW.Example.NET/en/x?q=/de/", "http://example.net", "http://example.net/enx",
            "http://a.example.com/de/1#f", "http://example.com/fr/1", "http://xexample.com/de/", "http://b.org/fr/", "http://org/fr/a",
            "http://borg/fr/", "x://a.net://b.org/fr/", "http://a.net/" + "y" * 50_000, "http://ÄB.net/é", "http://h.net\n/p", "http://a.net/", "http://x.adult-y.com", "http://spam-z.example.com/de/p",
            "http://www.casino-a.com/en/", "http://c.com/adult-x"]
    rows = [(k, u) for k, u in enumerate(urls)] + [(0, None), (None, "http://n.net/")]
    df = filter_urls(cases.frame(spark, rows, ("page_id", "url")), URL_RULES)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in df.collect()}
    assert df.count() == len(rows)
    rules = [("net", "/", "net/", "block"), ("example.net", "/en/", "example.net/en/", "allow"),
             ("example.com", "/de/", "example.com/de/", "block"), ("org", "/fr/", "org/fr/", "allow")]
    for k, u in enumerate(urls):
        host, path = "", ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
            tail = rest[end:]
            host = rest[:end].translate(cases.UPPER)
            path = tail[:min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
        fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        globbed = any(g in host for g in ("adult-", "casino-", "pills", "spam-"))
        best = max(fit, key=lambda r: len(r[2]), default=(None, None, None, "block" if globbed else "allow"))
        assert got[k] == (host, path, best[2], best[3]), u


def test_globs():
    globs = ["a*c", "a**c", "**/x?", "*.net/**", "q" * 70 + "*", "*", "?"]
    runs = Automaton(globs).run([b"abc", b"a/c", b"p/q/xy", b"a.net/b", b"q" * 75, b"", b"/", b"ac"])
    assert [[g for g, hit in zip(globs, row) if hit] for row in runs] == [
        ["a*c", "a**c", "*"], ["a**c"], ["**/x?"], ["*.net/**"], [globs[4], "*"], ["*"], [], ["a*c", "a**c", "*"]]
    assert Automaton([]).run([b"x"]).shape == (1, 0)


def test_url_ties_and_empty(spark):
    pages = cases.frame(spark, [(1, "http://h/p")], ("page_id", "url"))
    same = [Rule("h/p", "block", ("h/*",)), Rule("h/q", "allow", ("h/p",)), host_rule("h/", "allow")]
    assert filter_urls(pages, same).first().rule == "h/p"
    assert filter_urls(pages, []).first().verdict == "allow"
    assert filter_urls(cases.frame(spark, [], ("page_id", "url")), same).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T, t</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu, of, many, commas, and, words, here</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies, of course, and a long sentence about them, you know, so that it scores well.</p></div>
<div id="content"><h2>Head &amp; tail</h2><p>First  paragraph,&nbsp;with <b>bold</b>, <i>soft</i> words, and a <a href="x">link</a> in it.
<p>Second one<br>after a break, unclosed, &lt;kept&gt; &#233; &am
<script>var x = "</p><p>no</p>";</script><form><p>Name, mail, text</p></form><div class="ad">Buy, buy, buy, now, and, then, again</div>
<ul><li>One, item<li>Two, items</ul><pre>a   b</pre><table><tr><td>c1<td>c2</table><div hidden>gone</div></div>
<aside><p>Side, bar, text, which, is, rather, long, but, not, wanted, at, all, in, here, really.</p></aside>
<section class="comments"><p>A reader says: nice, good, great, long comment, with many commas, and more, and more.</p></section>
<footer><p>&copy; footer</p></footer></body></html>"""


def test_main_text():
    assert main_text(PAGE).split("\n\n") == [
        "Head & tail", "First paragraph, with bold, soft words, and a link in it.", "Second one after a break, unclosed, <kept> é &am",
        "One, item", "Two, items", "a b", "c1", "c2"]
    for odd in (None, "", "   ", "<", "<p", "<!--", "<script>x", "</p></div>", "<nav>only menu</nav>"):
        assert main_text(odd).strip("<p x") == ""
    assert main_text("just text,  no\ntags") == "just text, no tags"
    assert main_text("<p>" + "<b>" * 5000 + "deep") == "deep"
    assert len(main_text("<article><p>" + "word, " * 100_000)) == 599_999


def test_main_text_classes():
    def page(attributes, tag="div"):
        return main_text(f"<body><div><p>{'Good text, here. ' * 9}</p><{tag} {attributes}><p>other, text, there</p></{tag}></div></body>")

    for gone in ('class="ad"', "id=comments", 'class="x comment-list"', 'class="post-footer"', 'class="cookie-notice-bar"', "role=navigation",
                 "hidden", 'aria-hidden="true"', 'class="menu-item-3"'):
        assert "other" not in page(gone), gone
    for kept in ('class="adapted"', 'class="post-comments-open"', 'class="ad-free"', 'class="has-sidebar"', 'id="article-text"', "data-ad=x"):
        assert "other" in page(kept), kept
    assert "other" not in page('class="comment"', "article")
    assert main_text("<article><p>The one, and, only.</p></article><article><p>Next, please.</p></article>") == "The one, and, only."


def test_main_text_wrapped():
    prose = [f"Paragraph {k} of the story, told at length, with commas, and with more words than any notice has." for k in range(6)]
    article = "<h1>Title</h1>" + "".join(f"<p>{p}</p>" for p in prose)
    whole = ["Title", *prose]
    for start, end in (("<form id=aspnetForm>", "</form>"), ("<form><div class=widget>", "</div></form>"),
                       ('<div class="elementor-widget elementor-widget-text"><div class="elementor-widget-container">', "</div></div>"),
                       ('<div class="page-with-sidebar">', "</div>"), ('<div class="layout-no-sidebar">', "</div>"),
                       ('<div class="content-with-sidebar">', "</div>"), ('<div role=dialog><div class="modal-body">', "</div></div>"),
                       ("<aside>", "</aside>"), ('<div id=promo>', "</div>"), ('<article class="post no-comments">', "</article>")):
        page = (f"<body><div class=menu><p>Menu, home</p></div>{start}<div class=ad>Buy, buy, buy, now, and, then</div><nav>Go, on, to</nav>{article}"
                f"<section class=comments><p>A reader says: nice, good, great, long comment.</p></section>{end}<div>Left over</div></body>")
        assert main_text(page).split("\n\n")[:7] == whole, start
        assert "Buy" not in main_text(page) and "reader" not in main_text(page) and "Menu" not in main_text(page) and "Go" not in main_text(page)
    # An article in pieces, each in a widget of its own.
    page = "<body><div>" + "".join(f"<div class=elementor-widget><div class=elementor-widget-container><p>{p}</p></div></div>" for p in prose)
    assert main_text(page + "</div><p>Short, end.</p></body>").count("Paragraph") >= 1
    # Longer than the article, but none: comments, consent, sidebars.
    for unwanted in ("section class=comments", "div class=cookie-notice", "div role=dialog class=consent", "div class=sidebar", "footer", "div class=ad"):
        page = f"<body><div><p>{prose[0]}</p></div><{unwanted}>{article.replace('<h1>Title</h1>', '')}</{unwanted.split()[0]}></body>"
        assert main_text(page) == prose[0], unwanted


def test_main_text_parts():
    long = "<p>" + "A long paragraph, told at length, with commas, and more words, and on. " * 8 + "</p>"
    short = "<p>" + "Of no commas and few words but of the article all the same. " * 2 + "</p>"
    first, rest = f"<section>{long * 3}</section>", f"<section>{short}</section>"
    links = "<ul><li><a href=a>Other page of the site</a><li><a href=b>One more page, of, the, site</a></ul>"
    text = main_text(f"<body><div><h1>Title</h1>Bare text<b>!</b>{first}<h2>Next <a href=x>part</a></h2>{rest}<p>Short.<ul><li>One<li>Two</ul>"
                     f"<h2><a href=y>Linked</a></h2><p>Tail.</p>{links}</div></body>").split("\n\n")
    assert text[:2] == ["Title", "Bare text!"] and text[5] == "Next part" and "all the same" in text[6]
    assert text[7:] == ["Short.", "One", "Two", "Linked", "Tail."]
    # Bare text keeps the links in it; links alone are left out.
    text = main_text(f"<body><div>{first}See <a href=x>this page</a> for what came of it.{links}</div>")
    assert text.endswith("See this page for what came of it.") and "Other page" not in text
    # Each part in wrappers of its own, and a section that outweighs the article around it.
    rows = "".join(f"<div><div>{x}</div></div>" for x in (first, rest, "<p>Short.</p>"))
    for page in (f"<body><div>{rows}</div>", f"<body><article><h1>T</h1>{rows}</article>", f"<body><main>{first * 3}<div>{rest}</div>Short.</main>"):
        text = main_text(page)
        assert "all the same" in text and text.endswith("Short."), page[:30]


def test_extract_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<article><p>a"), (3, "w", "")]
    df = extract_main_text(cases.frame(spark, rows, ("page_id", "url", "html"), ("bigint", "string", "string")))
    got = [tuple(r) for r in df.collect()]
    assert sorted(((p, u, n) for p, u, t, n in got), key=repr) == sorted(((p, u, len(main_text(h))) for p, u, h in rows), key=repr)
    assert extract_main_text(cases.frame(spark, [], ("page_id", "url", "html"), ("bigint", "string", "string"))).collect() == []


@pytest.mark.parametrize("items", [
    [(1, cases.prose(2, 60)), (20, cases.prose(5, 12)), (3, "one two"), (3, "one two"), (11, None), (12, " ,. "), (None, "alone here")], []])
def test_contamination(spark, items):
    rows = cases.documents()
    bench = cases.frame(spark, items, ("item_id", "text"))
    got = find_contaminated(cases.frame(spark, rows), bench)
    assert cases.rows_of(got) == sorted(cases.contaminated(rows, items), key=repr)
    assert find_contaminated(cases.frame(spark, []), bench).collect() == []


def test_span_removal(spark):
    rows = [(1, "Keep this. A b-c d! And: that"), (2, None), (3, "nothing"), (4, "a B c D a b c d")]
    got = {r.doc_id: r.text for r in remove_spans(cases.frame(spark, rows), cases.frame(spark, [(1, "a b c d")], ("item_id", "text"))).collect()}
    assert got == {1: "Keep this.  - ! And: that", 2: None, 3: "nothing", 4: "       "}


def test_token_counts(spark):
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(3)
    odd = ["".join(rng.choice(" \n\t▁ab<s>é世\x00\u2003'.,1") for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    counter = PieceCounter(PIECES)
    assert counter.counts(odd) == [len(x) for x in pieces.encode(odd)]
    rows = cases.documents()
    got = count_tokens(cases.frame(spark, rows), PIECES)
    expected = [(i, len((t or "").encode()), len(pieces.encode(t or "")), len(pieces.encode(t or "")) > 4096) for i, t in rows]
    assert cases.rows_of(got) == sorted(expected, key=repr)
    assert count_tokens(cases.frame(spark, []), PIECES).collect() == []


def test_secrets(spark):
    key = "9f" + "3b7a1c" * 6
    uuid = "123e4567-e89b-12d3-a456-426614174000"
    rows = [(1, f'é token = "{key}" and AKIA{"Q7" * 8} AKIA{"Q" * 15}'), (2, "password: abcde secret=abcdef Api_Key:'x.y-z/1'"),
            (3, "secret: token: abcdef"), (4, "a1" * 11 + " " + "ab" * 11), (5, None), (6, ""), (7, "zX8kQ2vR7tLp0WmNs4Yb " + uuid), (7, "ſecret=abcdef"),
            (8, "thatiswithoutanydigits" * 3)]
    got = {(r.doc_id, r.n_assign, r.n_access, r.n_hex): r.spans for r in find_secrets(cases.frame(spark, rows)).collect()}
    text = rows[0][1]
    a, h, k = text.index("token"), text.index(key), text.index("AKIA")
    assert got[1, 1, 1, 1].startswith(f"assign:{a}:{h + len(key)},hex:{h}:{h + len(key)}")
    assert f"access:{k}:{k + 20}" in got[1, 1, 1, 1]
    assert got[2, 2, 0, 0].startswith("assign:16:29,assign:30:")
    assert (3, 0, 0, 0) in got and got[5, 0, 0, 0] == got[6, 0, 0, 0] == got[8, 0, 0, 0] == ""
    assert got[4, 0, 0, 0] == "" and got[7, 0, 0, 0] in ("entropy_mixed:0:20", "")
    assert find_secrets(cases.frame(spark, [])).collect() == []


def test_secrets_in_runs(spark):
    base64_key = "k3Zr/Q9xT+b7LmYw/2VcHs8NdPfG/u5JaKe1RoXtB/i6WqSzDy4M0vEhCnFgUlOpAj7T3kR9cZ+5XbN1w8Q2sL=="
    path_key, hexes = "zX8kQ2vR7tLp0WmNs4YbQ9aE", "9F3B7A1C08D2E45F6A7B0C9D8E1F2A34"
    cases_ = [  # text, kind, secret
        (f"key {base64_key} end", "entropy_mixed", base64_key),
        (f"AWS={base64_key[:40]}", "entropy_mixed", base64_key[:40]),
        (f"é https://hooks.example.com/services/T02ABCDEF/B03GHIJKL/{path_key}", "entropy_mixed", path_key),
        (f"https://localhost/{path_key}/info", "entropy_mixed", path_key), (f"api/v1/{path_key}", "entropy_mixed", path_key),
        ("HMAC=" + hexes, "entropy_hex", hexes), ("xyz-" + hexes.lower(), "entropy_hex", hexes.lower())]
    rows = [(k, t) for k, (t, _, _) in enumerate(cases_)]
    got = {r.doc_id: r.spans.split(",") for r in find_secrets(cases.frame(spark, rows)).collect()}
    for k, (text, kind, secret) in enumerate(cases_):
        a = text.index(secret)
        spans = [s for s in got[k] if s.startswith("entropy_")]
        if kind == "entropy_hex" and "=" not in text:  # windows with the name in them are of another class
            spans = [s for s in spans if s.startswith(kind)]
        assert spans == [f"{kind}:{a}:{a + len(secret)}"], (text, got[k])
    # A value too short for a window keeps those that begin in its name.
    short = "password=7602ad27cf5550de"
    assert windows_above(short, 3.75) and class_spans(short) == [("entropy_mixed", a, b) for a, b in windows_above(short, 3.75)]
    assert [x[1] for x in Scanner(ALLOWED).scan([short.encode()])[0]] == [0, 4]
    plain = ["usr/lib/x86_64-linux-gnu/python3.13/site-packages/module2", "api/v1/123e4567-e89b-12d3-a456-426614174000/x",
             "id=123e4567-e89b-12d3-a456-426614174000", "some-post-title-of-2024-part-2"]
    assert all(not r.n_entropy for r in find_secrets(cases.frame(spark, list(enumerate(plain)))).collect())


def test_secrets_random_keys():
    rng, scanner = random.Random(6), Scanner(ALLOWED)
    for n in (30, 66, 258, 1200):
        keys = [base64.b64encode(rng.randbytes(n)) for _ in range(100)]
        assert sum(bool(f) for f in scanner.scan(keys)) >= 99, n
    # Each window has the first class that holds it, as brute force finds.
    for _ in range(100):
        text = "".join(rng.choice(("0123456789abcdef", "0123456789ABCDEF", "ghXYZ19")[rng.random() > 0.8 and rng.randint(0, 2)]) for _ in range(90))
        want = defaultdict(set)
        for k in range(len(text) - 19):
            part = text[k:k + 20]
            kind, bits = next((c.kind, c.bits) for c in CLASSES if set(part) <= set(c.members))
            if windows_above(part, bits):
                want[kind] |= set(range(k, k + 20))
        spans = class_spans(text)
        assert {kind: {i for k, a, b in spans if k == kind for i in range(a, b)} for kind, _, _ in spans} == want


def test_entropy_window():
    def plain(text, bits, w=20):
        hit = set()
        for k in range(len(text) - w + 1):
            part = text[k:k + w]
            p = [part.count(c) / w for c in set(part)]
            if -sum(x * np.log2(x) for x in p) >= bits - 1e-9 and any(c.isdigit() for c in part) and any(c.isalpha() for c in part):
                hit |= set(range(k, k + w))
        return hit

    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice("abcdef0123"[:rng.randint(2, 10)]) for _ in range(rng.randint(5, 60)))
        spans = windows_above(text, 2.8)
        assert {i for a, b in spans for i in range(a, b)} == plain(text, 2.8)


def test_bpe(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(BYTES)
    rows = cases.documents()
    got = bpe.round_trip(cases.frame(spark, rows), BYTES)
    expected = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), cases.sha(text.encode())))
    assert cases.rows_of(got) == sorted(expected, key=repr)
    ids = bpe.encode(cases.frame(spark, rows), BYTES)
    assert sorted((r.text for r in bpe.decode(ids, BYTES).collect())) == sorted(t or "" for _, t in rows)
    assert bpe.round_trip(cases.frame(spark, []), BYTES).collect() == []


def test_bpe_tree():
    from tokenizers import Tokenizer

    lib, codec, rng = Tokenizer.from_file(BYTES), bpe.Codec(BYTES), random.Random(8)
    texts = [s * n for s in ("a", "ab", "the", "=", " ", "\n", "é", "🙂", "ing=") for n in (255, 256, 257, 1500)]
    texts += ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(250, 4000))) for _ in range(40)]
    for t in texts:
        assert np.frombuffer(codec.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, t[:20]


def test_bpe_long_texts_in_rows(spark):
    from tokenizers import Tokenizer

    lib, rng = Tokenizer.from_file(BYTES), random.Random(21)
    letters = "".join(rng.choice("etaoinshr") for _ in range(40_000))
    spaces = "".join(rng.choice(["a", "é", " ", "  ", "\n", "\t ", "12", "'s", "don't", "🙂", "<|endoftext|>", ", "]) for _ in range(4_000))
    rows = [(1, letters), (2, "a" * 20_001), (None, letters), (3, spaces), (4, spaces[:900] + letters[:9_000] + " " + spaces + "é" * 5_000),
            (5, " " * 3_000 + "x" + "\n" * 3_001), (5, "<|endoftext|>" * 300), (6, None), (7, ""), (8, "short"), (9, "ing=" * 6_000)]
    got = bpe.encode(cases.frame(spark, rows), BYTES, long_bytes=1_000, piece_bytes=300).collect()
    expected = [(i, lib.encode(t or "", add_special_tokens=False).ids) for i, t in rows]
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=repr) == sorted(expected, key=repr)
    both = [bpe.round_trip(cases.frame(spark, rows), BYTES, with_ids=True, **sizes) for sizes in ({}, {"long_bytes": 1_000, "piece_bytes": 700})]
    assert cases.rows_of(both[0]) == cases.rows_of(both[1]) and both[0].schema == both[1].schema


def test_quality(spark):
    rng = random.Random(4)
    good = [(k, cases.prose(1000 + k, rng.randint(20, 80))) for k in range(150)]
    bad = [(500 + k, " ".join(w + rng.choice(["###", "!!", "%%%"]) for w in cases.prose(3000 + k, rng.randint(20, 80)).split())) for k in range(60)]
    rows = [*good, *bad, (900, None), (901, ""), (None, "text"), (0, good[0][1])]
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(900, None, None), (None, 1, 0), (901, 7, 0)]
    docs = cases.frame(spark, rows)
    marks = cases.frame(spark, labels, ("doc_id", "quality", "toxic"), ("bigint", "int", "int"))
    model = train(docs, marks)
    got = score_quality(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    import zlib
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    known = {i: q for i, q, _ in labels}
    tested = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert sum(r.predicted == known[r.doc_id] for r in tested) / len(tested) > 0.95
    kept = keep_quality(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)
    # One class only, or no labels, gives a constant score.
    one = train(docs, marks.where("quality = 1"))
    assert {r.score for r in score_quality(docs, one).collect()} == {1.0}
    assert {r.score for r in score_quality(docs, train(docs, marks.limit(0))).collect()} == {0.5}
    assert score_quality(cases.frame(spark, []), model).collect() == []
    assert train(docs, marks).weights.tolist() == model.weights.tolist()


def test_quality_sample(spark):
    """A rare class, and labels of ids that no document has, leave rows of both classes to fit."""
    rows = [(k, cases.prose(k, 30)) for k in range(300)] + [(k, "### !!! %%% " * 10) for k in range(300, 306)]
    labels = [(i, int(i < 300)) for i, _ in rows] + [(i, i % 2) for i in range(1000, 4000)]
    docs = cases.frame(spark, rows)
    model = train(docs, cases.frame(spark, labels, ("doc_id", "quality"), ("bigint", "int")), sample=8)
    assert not isinstance(model, float)
    got = {r.doc_id: r.predicted for r in score_quality(docs, model).collect()}
    assert all(got[i] == 0 for i in range(300, 306)) and sum(got[i] for i in range(300)) > 285
    strange = cases.frame(spark, labels[306:], ("doc_id", "quality"), ("bigint", "int"))
    assert train(docs, strange) == 0.5


def test_features_are_indicators():
    once, twice, none = features([b"a b", b"a b a b", b""])
    assert len(set(twice.tolist())) == len(twice) and set(once[:2].tolist()) <= set(twice.tolist()) and len(none) == 0
