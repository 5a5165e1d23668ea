"""Pages made around known articles, and secrets found by a slow reading of the rules."""

import random
import re
import string
import time

import cases
import pytest

from lacuna.llm.html_extract import main_text
from lacuna.llm.secrets import ALLOWED, KINDS, PLACEHOLDERS, WINDOW, Scanner, candidates, class_spans, find_secrets


def sentence(rng, words):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(words)).capitalize() + "."


def made_page(rng):
    """A page and the blocks of its article."""
    blocks, parts = [], []

    def add(tag, text, attributes=""):
        blocks.append(text)
        parts.append(f"<{tag}{attributes}>{text.replace('&', '&amp;')}" + (f"</{tag}>" if tag != "p" or rng.random() < 0.5 else ""))

    add("h1", sentence(rng, 5))
    for _ in range(rng.randint(3, 8)):
        kind = rng.random()
        if kind < 0.6:
            odd = rng.choice(["", " title=it's", ' class="lead" data-x=\'a > b\'', " id=p1", ' title="a>b"'])
            add("p", ", ".join(sentence(rng, rng.randint(8, 20))[:-1] for _ in range(3)) + " & so on.", odd)
        elif kind < 0.75:
            add("h2", sentence(rng, 3))
            add("p", sentence(rng, rng.randint(20, 40)))
        elif kind < 0.9:
            parts.append("<ul>")
            for _ in range(3):
                add("li", sentence(rng, rng.randint(3, 8)))
            parts.append("</ul>")
        else:
            add("blockquote", sentence(rng, 25))
    if rng.random() < 0.5:
        add("h2", "Sources")
        parts.append("<ul>")
        for _ in range(3):
            blocks.append(text := sentence(rng, 4))
            parts.append(f"<li><a href=/x?{rng.randint(0, 99)}>{text}</a></li>")
        parts.append("</ul>")
    article = "".join(parts)
    if rng.random() < 0.3:
        article = f"<header>{parts[0]}</header>" + "".join(parts[1:])
    depth = rng.choice([0, 1, 3, 520, 3000])
    article = f"<article>{'<div>' * depth}{article}{'</div>' * depth}</article>"
    if rng.random() < 0.3:
        article = f"<main>{article}<div class=related><a href=/r>More, to, read</a></div></main>"
    advert = "<div class=ad><p>BUY NOW, now, and now, this is an offer, that is, an advert</p></div>"
    where = rng.random()
    if where < 0.3:
        article = advert + article
    elif where < 0.6:
        article = article.replace("</article>", advert + "</article>")
    menu = "<nav><ul><li><a href=/>Home</a><li><a href=/b>Blog, all of it</a></ul></nav>"
    footer = "<footer><p>Copyright, imprint, and all that</p></footer>"
    page = (f"<html><head><title>T</title><script>if (a < b) {{ x = '<p>'; }}</script></head><body>{menu}<header><h2>Site name</h2></header>{article}"
            f"<div id=comments><p>A reader, who says, well, something</p></div>{footer}</body></html>")
    return page, blocks


def test_200_made_pages():
    rng = random.Random(11)
    for k in range(200):
        page, blocks = made_page(rng)
        assert main_text(page) == "\n\n".join(blocks), k


def test_quotes_only_open_values():
    assert main_text("<p title=it's>SECOND</p><p>THIRD</p><p title=it's>FOURTH</p>") == "SECOND\n\nTHIRD\n\nFOURTH"


@pytest.mark.parametrize("page", [
    "<div>" * 60_000 + "text", "<span>" * 60_000 + "text", "<blockquote>" * 60_000 + "text", "</b>" * 60_000 + "text", "<p>" * 60_000 + "text",
    "<span>" * 30_000 + "text" + "</b>" * 30_000, "<a x=\"1\" " * 20_000 + "text", "<li><p>" * 30_000 + "text", "<table><tr><td>" * 20_000 + "text"])
def test_odd_pages_take_no_long_time(page):
    began = time.monotonic()
    main_text(page)
    assert time.monotonic() - began < 8


def entropy_by_hand(text, allowed=tuple(re.compile(p) for p in ALLOWED)):
    """Added spans of a text of one line, run by run."""
    out = []
    for run in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        if not re.search(r"[0-9]", run[0]):
            continue
        before = text[:run.start()]
        url = "/" in run[0] and bool(
            re.search(r"://[^\s?#\"'<>]*$", before) or before.endswith(":") and run[0].startswith("//")
            or re.match(r"[a-z]{2,10}/", run[0]) and re.search(r"[A-Za-z0-9-]\.$", before))
        for at, found in candidates(run[0], url):
            if len(found) < WINDOW or any(p.fullmatch(found.rstrip("=")) for p in allowed):
                continue
            touched = {i for m in PLACEHOLDERS.finditer(found) for i in range(*m.span())}
            pieces = "".join("\n" if i in touched else c for i, c in enumerate(found))
            for piece in re.finditer(r"[^\n]{20,}", pieces):
                out += [(kind, run.start() + at + piece.start() + a, run.start() + at + piece.start() + b) for kind, a, b in class_spans(piece[0])]
    return out


def by_hand(text):
    """All spans of a text: (start, kind, end), kinds by number."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    found += [(a, KINDS.index(kind), b) for kind, a, b in entropy_by_hand(text)]
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def secret_texts():
    rng = random.Random(4)
    key = lambda n, chars=string.ascii_letters + string.digits: "".join(rng.choice(chars) for _ in range(n))
    bits = [lambda: f"password = '{key(12)}'", lambda: f"API_KEY:{key(30)}", lambda: f"AKIA{key(18, string.ascii_uppercase + string.digits)}",
            lambda: key(40, "0123456789abcdef"), lambda: key(50, string.ascii_letters + string.digits + "+/") + "==", lambda: "é ü",
            lambda: f"https://a.example/{key(8)}/{key(30)}?q={key(25)}", lambda: "words, and words.", lambda: "example-" + key(40),
            lambda: key(40) + "xxxx", lambda: f"site.com/{key(22)}/x", lambda: "a-slug-of-words-and-2024-more", lambda: key(10) + "/" + key(24),
            lambda: f"token: {'abcdefghij' * 3}{key(25)}", lambda: "secret=" + key(5), lambda: "://" + "p" * 3000 + "/" + key(24)]
    return [" ".join(rng.choice(bits)() for _ in range(rng.randint(1, 8))) for _ in range(300)]


def test_secrets_of_whole_rows(spark):
    texts = secret_texts()
    got = {r.doc_id: r.spans for r in find_secrets(cases.frame(spark, list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        assert got[k] == by_hand(text), text


def test_allow_list_judges_parts():
    rng, scanner = random.Random(8), Scanner(ALLOWED)
    chars = string.ascii_letters + string.digits
    key = "".join(rng.choice(chars) for _ in range(40))
    groups = "-".join("".join(rng.choice(string.ascii_lowercase + string.digits) for _ in range(10)) for _ in range(5))
    for text in ("example-" + key, key + "xxxx", "A1B2C3D4E5F6-G7H8J9K0L1M2-N3P4Q5R6S7T8-U9V0W1X2Y3Z4", groups):
        assert scanner.scan([text.encode()])[0], text
    assert scanner.scan([b"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"])[0] == []
    for size, times in ((5000, 100), (50_000, 30)):
        for _ in range(times):
            text = "".join(rng.choice(chars) for _ in range(size))
            spans = scanner.scan([text.encode()])[0]
            assert sum(b - a for a, k, b in spans if k >= 3) > 0.9 * size


@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_contamination_with_and_without_broadcast(spark, monkeypatch, broadcast):
    from lacuna.llm import decontaminate

    monkeypatch.setattr(decontaminate, "WINDOWS_BROADCAST", broadcast)
    items = [("a", cases.prose(2, 60)), ("b", "one two"), ("c", None), (None, cases.prose(3, 12))]
    rows = cases.documents()
    found = decontaminate.find_contaminated(cases.frame(spark, rows), cases.frame(spark, items, ("item_id", "text"), ("string", "string")))
    assert cases.rows_of(found) == sorted(cases.contaminated(rows, items), key=repr)


def test_ids_outside_the_vocabulary_spell_nothing(spark):
    import numpy as np
    import public_tokenizers

    from lacuna.llm import bpe

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = bpe.encode(spark.createDataFrame([(1, "some words"), (1, "some words")], "doc_id int, text string"), path)
    odd = [(r.doc_id, bytes(r.ids) + np.array([10**9, 2**32 - 1], "<u4").tobytes()) for r in ids.collect()]
    got = bpe.decode(spark.createDataFrame([*odd, (None, None)], "doc_id int, ids binary"), path)
    assert sorted((r.doc_id, r.text) for r in got.collect() if r.doc_id) == [(1, "some words")] * 2
