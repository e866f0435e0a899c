"""Chosen blocks outside the container, and furniture names on wrappers of the content."""

from tollgate.llm.tag_paths import main_text

LONG = "This is a long sentence, with several marks, that reads like the text of an article; it goes on. "
CHROME = "<nav><a>Home</a></nav><div class='comments'><p>I agree, really.</p></div><footer>me</footer>"


def test_chosen_blocks_outside_the_container_stay():
    page = f"<body><div><p>Intro: {LONG}</p></div><div id='x'>" + f"<p>{LONG * 3}</p>" * 10 + "</div><div><p>a</p><p>b</p><p>c</p></div></body>"
    got = main_text(page)
    assert got.startswith("Intro:") and got.count("reads like") == 31
    two = f"<body><article><p>{LONG * 4}</p></article><article><p>Second. {LONG * 3}</p></article></body>"
    assert main_text(two).count("reads like") == 7


def test_wrappers_of_the_content_are_no_furniture():
    text = f"{LONG * 3}".strip()
    for before, after in (("<div class='has-sidebar'>", "</div>"), ("<form id='aspnetForm'>", "</form>"),
                          ("<form><div id='page-header tags'>", "</div></form>")):
        for start, stop in (("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>")):
            assert main_text(f"<body>{before}{CHROME}{start}<p>{text}</p>{stop}{after}</body>") == text


def test_furniture_beside_the_content_stays_out():
    text = LONG.strip()
    comments = f"<div class='comments'><article><p>{LONG * 5}</p></article></div>"
    assert main_text(f"<body><article><p>{text}</p></article>{comments}</body>") == text
    assert main_text(f"<body><nav>{LONG * 5}</nav><div hidden class='ad'>{LONG * 9}</div><p>{text}</p></body>") == text
