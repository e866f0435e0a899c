"""Path ratios against plain arithmetic, pages where only they find the content, malformed and very long pages."""

import time

import numpy as np
import pytest

from tollgate.llm import tag_paths
from tollgate.llm.tag_paths import main_text, path_ratios

LONG = "This is a long sentence, with several marks, that reads like the text of an article; it goes on."
MENU = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in ("Home", "World", "Sport", "Login"))
BODY = f"<h2>The headline</h2><p>{LONG} {LONG}</p><ul><li>Apples</li><li>Pears</li></ul><p>{LONG}</p><blockquote><p>{LONG} {LONG} {LONG}</p></blockquote>"
TEXT = "\n\n".join(["The headline", f"{LONG} {LONG}", "Apples", "Pears", LONG, f"{LONG} {LONG} {LONG}"])
PAGES = {
    "no article": f"<body><div class='k1'><ul>{MENU}</ul></div><div class='k2'>{BODY}</div><div class='k3'>Made by us</div></body>",
    "sibling divs": f"<body><div><div><ul>{MENU}</ul></div><div>{BODY}</div><div><span>Imprint</span></div></div></body>",
    "menu in the same div": f"<body><div class='k2'><ul>{MENU}</ul>{BODY}</div></body>",
    "furniture under neutral names": f"<body><div class='q4'>Do you accept this, reader?</div><div class='z'>{BODY}</div><div class='w8'><p class='u'>Free offer</p><p class='u'>Only now</p></div></body>",
    "menu in an article": f"<body><div class='q'>Short line</div><article>{BODY}<ul>{MENU}</ul></article></body>",
}


@pytest.mark.parametrize("name", PAGES)
def test_ratios_find_the_content(name):
    assert main_text(PAGES[name]) == TEXT


def test_without_ratios_the_content_is_not_found(monkeypatch):
    monkeypatch.setattr(tag_paths, "path_ratios", lambda paths, texts: (np.ones(len(paths)), np.ones(len(paths))))
    assert all(main_text(page) != TEXT for page in PAGES.values())


def test_ratios_against_plain_arithmetic():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = int(rng.integers(1, 30))
        paths = rng.integers(1, 6, n).tolist()
        texts = ["".join(rng.choice(list("ab ,.!"), int(rng.integers(1, 40)))) for _ in range(n)]
        mean = lambda values: [sum(v for v, q in zip(values, paths) if q == p) / paths.count(p) for p in paths]
        smooth = lambda x: [0.25 * x[max(i - 1, 0)] + 0.5 * x[i] + 0.25 * x[min(i + 1, n - 1)] for i in range(n)]
        size = mean([len(t) for t in texts])
        marks = [m + 0.5 for m in mean([sum(c in ",.!" for c in t) for t in texts])]
        fused = [(a * b * c * d) ** 0.5 for a, b, c, d in zip(size, marks, smooth(size), smooth(marks))]
        got = path_ratios(paths, texts)
        assert np.allclose(got[0], mean(fused)) and np.allclose(got[1], fused)


def test_attributes_of_any_kind():
    for start in ("<p data-x=it's>", "<p a=\"it's > that\">", "<p a='x\" >' b>", "<p/class=x>", "<p a = b>", "<p =>", "<p 'x\">", "<p\nid=\"\">"):
        assert main_text(f"<article>{start}{LONG}</p><p>{LONG}</p></article>") == f"{LONG}\n\n{LONG}", start
    assert main_text(f"<article><p>{LONG}</p><p a=\"x>never closed</p></article>") == LONG + "\n\nnever closed"
    assert main_text(f"a < b, <3 and </ this>{LONG}") == f"a < b, <3 and {LONG}"


def test_opening_of_the_article_is_no_furniture():
    page = f"<body><article><div class='article-header'><p>{LONG}</p></div><p>{LONG}</p><div class='article-comments'><p>{LONG}</p></div></article></body>"
    assert main_text(page) == f"{LONG}\n\n{LONG}"


@pytest.mark.parametrize("part", ["<p a=\"", "<b a='x ", "<div>", "<div>x</p>", "<svg>", "<svg></svg ", "<form>a, b ", "<!", "<", "= ", "<!--",
                                  "</p", "<a href=x>y", "<div class='a'>x.</div>"])
def test_time_is_linear_in_the_page(part):
    page = "<p " + part * (1_000_000 // len(part)) if part == "= " else part * (1_000_000 // len(part))
    before = time.process_time()
    main_text(page)
    assert time.process_time() - before < 20  # About 2 s; anything quadratic takes minutes.


def test_table_with_clashing_columns_repeats_and_no_rows(spark):
    rows = [(1, "u", PAGES["no article"], "a", "b"), (1, "u", PAGES["no article"], "a", "b"), (2, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars string")
    got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in tag_paths.extract(df).collect())
    assert got == [(1, TEXT, len(TEXT))] * 2 + [(2, "", 0)]
    assert tag_paths.extract(df.limit(0)).count() == 0 and tag_paths.extract(df).columns == ["page_id", "url", "text", "n_chars"]
