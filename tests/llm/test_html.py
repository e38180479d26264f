"""Main text of generated pages whose content is known, and evidence against first assumptions."""

import html as entities
import random

import pytest

from gleaner.llm import html
from gleaner.llm.html import Weights, extract_text, prior

WORDS = "stone river house winter letter garden window market summer bridge".split()
OUTSIDE = [
    ("nav", ""), ("header", ""), ("footer", ""), ("aside", ""), ("form", ""), ("div", "sidebar"), ("div", "ad-box"), ("div", "cookie-bar"),
    ("ul", "menu"), ("section", "comments"), ("div", "share-buttons"), ("div", "site-footer"), ("div", "newsletter-box"), ("div", "related-links"),
]


def words(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def block(rng):
    """(html, text) of a content block: references, white space and inline tags."""
    own = words(rng, rng.randrange(12, 30))
    own[0] = own[0].capitalize()
    own[2] = "a<b & c"
    marked = [entities.escape(w) for w in own]
    marked[4] = f"<b>{marked[4]}</b>"
    marked[6] = f'<a href="#">{marked[6]}</a>'
    kind = rng.choice(["p", "p", "p", "h2", "li", "blockquote", "pre"])
    return f"<{kind}>\n  " + rng.choice([" ", "\n\t"]).join(marked) + f" </{kind}>", " ".join(own)


def boilerplate(rng, within=False):
    """Within an article a header is the article's own."""
    tag, name = rng.choice([x for x in OUTSIDE if not within or x[0] != "header"])
    links = "".join(f'<a href="/{w}">{w}</a> ' for w in words(rng, rng.randrange(2, 9)))
    return f'<{tag} class="{name}">{links}<script>var a = "</p>";</script><!-- x --></{tag}>'


def page(rng, marked=True):
    blocks = [block(rng) for _ in range(rng.randrange(4, 9))]
    body, texts = "", []
    for h, t in blocks:
        body += h
        texts.append(t)
        if rng.random() < 0.25:
            body += boilerplate(rng, True)
    front, behind = ("".join(boilerplate(rng) for _ in range(rng.randrange(1, 4))) for _ in range(2))
    content = f"<article>{body}</article>" if marked else f'<div class="entry-content">{body}</div>'
    return f"<html><head><title>{rng.choice(WORDS)}</title></head><body>{front}{content}{behind}</body></html>", "\n".join(texts)


@pytest.mark.parametrize("marked", [True, False])
@pytest.mark.parametrize("seed", range(60))
def test_generated_pages(seed, marked):
    made, want = page(random.Random(seed), marked)
    assert extract_text(made, Weights()) == want


def test_fitted_weights_keep_generated_pages_right(spark):
    rng = random.Random(5)
    pages = [page(rng, k % 3 > 0) for k in range(150)]
    frame = spark.createDataFrame([(k, "u", h) for k, (h, _) in enumerate(pages)], "page_id long, url string, html string")
    got = {r["id"]: r["text"] for r in html.extract(frame, html.fit(frame)).collect()}
    assert got == {k: t for k, (_, t) in enumerate(pages)}


def test_evidence_overturns_a_first_assumption(spark):
    """A box that all labelled pages use for article text is content, on other pages as well."""
    text = " ".join(WORDS * 4)
    labelled = [f"<body><nav>a b</nav><article><p>{text}</p><div class='legal'><p>{text} {k}</p></div></article></body>" for k in range(30)]
    other = f"<body><nav>x y</nav><div class='content'><p>{text}</p><div class='legal'><p>{text} end</p></div></div></body>"
    assert "end" not in extract_text(other, Weights())
    frame = spark.createDataFrame([(k, "u", h) for k, h in enumerate(labelled)], "page_id long, url string, html string")
    weights = html.fit(frame)
    assert "end" in extract_text(other, weights) and "x y" not in extract_text(other, weights)
    assert extract_text(labelled[3], weights) == f"{text}\n{text} 3"


def test_headings_formulas_and_doubtful_names_stay_in_articles():
    text = " ".join(WORDS * 3)
    made = (
        f"<article><div class='entry-header'><h1>Title of it</h1></div><p>{text}</p><div class='share-prices'>prices rose</div>"
        f"<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p><div class='share-buttons'>tweet</div><p>{text}</p></article>"
    )
    assert extract_text(made, Weights()) == f"Title of it\n{text}\nprices rose\nso x=1 holds\n{text}"


def test_class_words_are_read_by_their_parts():
    assert prior(".share-buttons") < 0 and prior(".site-footer") < 0 and prior(".ad") < 0 and prior(".left-nav") < 0
    assert prior(".share-prices") == 0 and prior(".header-image-credits") == 0 and prior(".x") == 0
    assert prior(".entry-content") > 0 and prior("nav") < 0 and prior("p") == 0
