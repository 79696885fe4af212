"""HTML extraction: ratios, smoothing and clusters by brute force, odd names and malformed pages."""

import math
import random
import time

import numpy as np
import pytest

from docfacts.llm import html_text

PROSE = "Long words of an article that go on and on. "
ARTICLE = "".join(f"<p>{PROSE * n}{n}.</p>" for n in (5, 8, 3))
TEXT = " ".join(f"{PROSE * n}{n}." for n in (5, 8, 3))
LINKS = "<ul>" + "".join(f"<li><a href='/{i}'>Other page {i}</a></li>" for i in range(8)) + "</ul>"


def brute_smoothed(values, sigma):
    reach, result = int(3 * sigma), []
    for i in range(len(values)):
        near = range(max(0, i - reach), min(len(values), i + reach + 1))
        weights = [math.exp(-0.5 * ((j - i) / sigma) ** 2) for j in near]
        result.append(sum(w * values[j] for w, j in zip(weights, near)) / sum(weights))
    return result


def test_clusters_by_brute_force():
    rng = random.Random(1)
    for n in (1, 2, 3, 8, 40, 200):
        lengths = [rng.choice([0, 3, 20, 400]) for _ in range(n)]
        tags = [rng.choice([0, 1, 2, 9]) for _ in range(n)]
        ratios = [size / max(1, t) for size, t in zip(lengths, tags)]
        even = brute_smoothed(ratios, html_text.SIGMA)
        assert np.allclose(html_text.smoothed(np.array(ratios)), even)
        mean = sum(ratios) / n
        spread = math.sqrt(sum((r - mean) ** 2 for r in ratios) / n)
        want = [e >= html_text.DEVIATIONS * spread and size > 0 for e, size in zip(even, lengths)]
        assert html_text.clusters(np.array(lengths, float), np.array(tags, float)).tolist() == want


def test_lines_and_their_tags():
    parser = html_text._Lines()
    parser.feed("<div>One <b>two</b><p><a href='x'>link</a> <a>only</a></p><p><a>link</a> and text<br>next</div>")
    parser.close()
    found = [(text, tags, links) for text, tags, _, links in parser.lines if text]
    assert found == [("One two", 3, False), ("link only", 5, True), ("link and text", 3, False), ("next", 1, False)]


@pytest.mark.parametrize("name", [
    "page sidebar-left", "main-content menu-open", "post has-share share-enabled", "no-sidebar", "layout--with-nav", "comments-open related",
])
def test_a_frame_is_content_whatever_its_name(name):
    for page in (f'<body><div class="{name}"><nav>Menu</nav>{ARTICLE}</div></body>', f'<body class="x"><main id="{name}">{ARTICLE}</main></body>'):
        assert html_text.main_text(page) == TEXT


@pytest.mark.parametrize("name", ["notice", "cookie-notice", "site-notice big", "menu", "ad", "comments", "sidebar-left", "subscribeBox", "no-print share"])
def test_elements_beside_the_content_go(name):
    beside = f"<div class='{name}'>Words beside the article, <b>some</b> more of them.</div>"
    for page in (f"<body>{beside}<div>{ARTICLE}</div></body>", f"<body><div>{ARTICLE}{beside}</div></body>"):
        assert html_text.main_text(page) == TEXT


def test_lists_of_links_go_by_their_ratio():
    assert html_text.main_text(f"<body><div>{ARTICLE}{LINKS}</div></body>") == TEXT
    assert html_text.main_text(f"<body><div>{LINKS}{ARTICLE}</div></body>") == TEXT
    within = ARTICLE + "<p><a href='s'>A source on its own line</a></p>" + ARTICLE
    assert html_text.main_text(f"<body><article>{within}</article></body>") == f"{TEXT} A source on its own line {TEXT}"
    plain = "<ul><li>First of a list</li><li>Second</li></ul>"
    assert html_text.main_text(f"<body><article>{ARTICLE}{plain}</article></body>") == f"{TEXT} First of a list Second"


@pytest.mark.parametrize("odd", ["<![foo[x]]>", "<![>", "<![a b c>", "<!>", "<!DOCTYPE", "<!ELEMENT x (y)>", "<![CDATA[ x ]]>", "<?php x ?>", "</>", "<!--->"])
def test_malformed_declarations_are_no_text(odd):
    end = "" if odd.endswith(">") else ">"
    assert html_text.main_text(f"<body>{odd}{end}<div>{ARTICLE}</div></body>") == TEXT
    html_text.main_text(f"<body><div>{ARTICLE}</div>{odd}")


def test_any_characters_are_borne():
    rng = random.Random(5)
    pieces = ["<", "!", "[", "]", ">", "-", "--", "a", "/", "p", "div", "<p>", "</p>", "<![", "<!", "<?", "&", "&#", "x", "\n", " ", '"', "'",
              "=", "class=menu", "\x00", "é", "<script>", "</script", "<!--", "-->", "<title>", "&#xD800;", "&#99999999;"]
    for _ in range(3000):
        html_text.main_text("".join(rng.choice(pieces) for _ in range(rng.randrange(50))))


def test_time_grows_with_the_page():
    start = time.monotonic()
    for n in (20_000,):
        html_text.main_text("<i><div>" + "<b>" * n + "</i>" * n + "</q>" * n + ARTICLE)
        html_text.main_text("<div>" * n + "</span>" * n + ARTICLE)
        html_text.main_text("<p>" * n + "</li>" * n + ARTICLE)
    assert time.monotonic() - start < 10
