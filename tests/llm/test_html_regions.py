"""The clusters, not the names of tags, choose the region."""

from tidemark.llm.html_extract import extract

LONG = "A sentence of the main text that goes on for a good while. " * 6
P = f"<p>{LONG}</p>"


def test_main_text_beside_a_short_article():
    text = extract(f"<body><main>{P * 4}</main><div><article><p>A card of a few words.</p></article></div></body>")
    assert text.count(LONG.strip()) == 4


def test_two_sibling_divs():
    text = extract(f"<body><div>{P * 9}</div><div>{P}</div></body>")
    assert text.count(LONG.strip()) == 10


def test_title_outside_the_div():
    text = extract(f"<body><h1>The title of it</h1><div>{P * 3}</div></body>")
    assert text.startswith("The title of it\n\n") and text.count(LONG.strip()) == 3


def test_an_article_with_all_of_it_is_the_region():
    assert extract(f"<body><div>x</div><article>{P * 3}</article></body>") == "\n\n".join([LONG.strip()] * 3)


def test_names_do_not_take_out_most_of_the_page():
    article = "\n\n".join(["The title", *[LONG.strip()] * 3])
    inner = f"<h1>The title</h1>{P * 3}"
    for page in (f'<article class="news-alert">{inner}</article>', f'<body><p>Hi there.</p><div class="ad-free-content">{inner}</div></body>', f'<main><div id="search-results">{inner}</div></main>', f"<article><header><h1>The title</h1><p>By A. Writer</p></header>{P * 3}</article>"):
        assert extract(page) == article, page


def test_a_teaser_beside_a_long_div():
    page = f"<body><article><p>A short teaser of another page.</p></article><div class=main>{P * 20}</div></body>"
    assert extract(page) == "\n\n".join([LONG.strip()] * 20)


def test_long_reader_comments_stay_out():
    comments = "".join(f"<div class=comment><p>{LONG}</p></div>" for _ in range(8))
    for name in ("comments", "comment-list", "reader comments-section"):
        assert extract(f'<body><div><h1>T</h1>{P * 3}</div><div class="{name}">{comments}</div></body>').count(LONG.strip()) == 3


def test_pages_without_semantic_tags():
    import random

    rng = random.Random(11)
    for _ in range(40):
        body = [f"Sentence {rng.random()} of the text that runs on and on, for this is prose, and prose it stays." * rng.randint(1, 4) for _ in range(rng.randint(3, 12))]
        menu = "".join(f"<li><a href=/{i}>Item {i}</a></li>" for i in range(rng.randint(3, 9)))
        page = f"<html><body><div class='top-menu'><ul>{menu}</ul></div><table><tr><td><ul>{menu}</ul></td><td><div><h1>Head</h1>{''.join(f'<p>{x}</p>' for x in body)}</div></td></tr></table><div id=footer><p>All rights are reserved by the owner of this site.</p></div></body></html>"
        assert extract(page) == "\n\n".join(["Head", *body])


def test_deep_pages_take_linear_time():
    import time

    def seconds(n):
        page = "<div><b>" * n + P
        t = time.perf_counter()
        assert extract(page) == LONG.strip()
        return time.perf_counter() - t

    seconds(1000)
    assert seconds(40_000) < 3


def test_a_head_without_its_end_tag():
    assert extract(f"<html><head><title>x</title><meta charset=utf-8><style>p{{}}</style><body><main>{P * 3}</main></body></html>") == "\n\n".join([LONG.strip()] * 3)
    assert extract(f"<head><title>x</title>{P}") == LONG.strip()
    assert extract(f"<title>x</title><body>{P}</body>") == LONG.strip()


def test_comments_stay_out_whatever_their_mass():
    comments = "".join(f"<div class=comment><p>Short comment number {i}, nice.</p></div>" for i in range(60))
    for name in ("comments", "comment-thread-list", "reader-comments-block"):
        for n in (1, 2, 10):
            for page in (f'<article>{P * n}</article><div class="{name}">{comments}</div>', f'<div><h1>T</h1>{P * n}</div><div class="{name}"><div class="{name}">{comments}</div></div>'):
                text = extract(f"<body>{page}</body>")
                assert text.count(LONG.strip()) == n and "Short" not in text
    assert extract(f'<body><div class="article-comments-open"><h1>T</h1>{P * 3}</div><div>{"tagline " * 20}</div></body>').count(LONG.strip()) == 3


def test_a_form_around_the_page_and_forms_on_it():
    assert extract(f"<body><form id=f><input type=hidden><div>{P * 4}</div><select><option>a</option></select><label>Name</label></form></body>") == "\n\n".join([LONG.strip()] * 4)
    assert extract(f"<body><div>{P * 4}</div><form><label>Email</label><input><p>Sign up</p></form></body>") == "\n\n".join([LONG.strip()] * 4)
    assert extract("<body><form><p>Search</p></form></body>") == ""


def test_parts_that_never_close():
    for start in ("<nav><ul><li><a href=x>Home</a></ul>", "<aside><p>Ad text</p>", "<header><a>Logo</a>", "<nav><a>x</a><aside><b>y</b>"):
        assert extract(f"<body>{start}<div>{P * 3}</div></body></html>") == "\n\n".join([LONG.strip()] * 3), start
        assert extract(f"<body>{start}<main>{P * 3}</main>") == "\n\n".join([LONG.strip()] * 3), start


def test_broken_markup_takes_linear_time():
    import time

    for part in ("<p a=\"'", "<a ", "<!-- x", "<", "&#", "<![CDATA[", "</", "<?x", "<!x", '<div class="comment">', "<title>", "<p a='", "<nav>"):
        times = []
        for size in (250_000, 1_000_000):
            page = "<p>x " + part * (size // len(part))
            t = time.perf_counter()
            extract(page)
            times.append(time.perf_counter() - t)
        assert times[1] < 8 * times[0] + 1, (part, times)


def test_random_pages_without_semantic_tags_against_their_parts():
    """Pages built from an article and parts to leave out, in random order, with names of no meaning and end tags left out at random."""
    import random

    rng = random.Random(5)
    for _ in range(60):
        body = [f"Sentence {rng.random()} of the text that runs on and on, for this is prose, and prose it stays. " * rng.randint(1, 4) for _ in range(rng.randint(3, 12))]
        end = rng.choice(["</p>", ""])
        head = f"<head><title>A title</title><meta name=x content=y>{rng.choice(['</head>', ''])}"
        links = "".join(f"<li><a href=/{i}>Item {i}</a>{rng.choice(['</li>', ''])}" for i in range(rng.randint(3, 9)))
        before = rng.choice([f"<ul>{links}</ul>", f"<div class=x1><ul>{links}</ul></div>", ""])
        after = "".join(f'<div class="reader-comment"><p>{"Nice one. " * rng.randint(1, 9)}</p></div>' for _ in range(rng.randint(0, 30)))
        page = f"<html>{head}<body><div>{before}</div><div class=q7>{''.join(f'<p>{x}{end}' for x in body)}</div><div class=comments>{after}</div></body></html>"
        assert extract(page) == "\n\n".join(x.strip() for x in body)
