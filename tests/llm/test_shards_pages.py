import math
import random
import zlib
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from fleetmart.llm import maintext, sharding


def least_capacity(sizes, shards):
    low, high = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)

    def fits(capacity):
        used, at = 1, 0
        for s in sizes:
            if at + s > capacity:
                used, at = used + 1, 0
            at += s
        return used <= shards

    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def checked(df, rows, shards):
    got = sharding.shard_by_bytes(df, shards, cells=64).collect()
    assert len(got) == len(rows)
    size = {}
    for r in got:
        size[r["shard"]] = size.get(r["shard"], 0) + r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    groups = (df.select(F.xxhash64("text").alias("g"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("s"))
              .groupBy("g").agg(F.sum("s").alias("s")).orderBy("g").collect())
    assert max(size.values()) == least_capacity([g["s"] for g in groups], shards)
    for shard in size:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    text = {i: t for i, t in rows}
    homes = {}
    for r in got:
        t = text[r["doc_id"]]
        assert r["size"] == len((t or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((t or "").encode())
        homes.setdefault(t, set()).add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())
    return got


@pytest.mark.parametrize("shards", [1, 4, 16])
def test_shards_are_minimax(spark, docs_of, shards):
    rng = random.Random(shards)
    rows = [(i, "x" * rng.randint(0, 60) + str(i)) for i in range(600)]
    rows += [(1000 + i, "copy of a hot text") for i in range(300)] + [(2000 + i, None) for i in range(20)] + [(3000, ""), (3001, "é" * 5000)]
    checked(docs_of(rows), rows, shards)


def test_shards_of_repeated_rows_and_little(spark, docs_of):
    assert sharding.shard_by_bytes(docs_of([])).count() == 0
    rows = [(1, "a"), (1, "a"), (2, "b")]
    got = sharding.shard_by_bytes(docs_of(rows)).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 1, 2]
    same = [(r["shard"], r["slot"]) for r in got if r["doc_id"] == 1]
    assert len({s for s, _ in same}) == 1 and len(set(same)) == 2


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><a href=/>x</a></nav><div class="cookie-notice">We use cookies a lot and like to tell you about it at length.</div>
<div id=main><div class="post"><h2>Head &amp; line</h2><p>One <b>two</b>three&nbsp;four. Long enough text of the article.
<p>Second   para <a href="x">link</a> with more text.<ul><li>a<li>b</ul></div><div class="sidebar">Side text side text</div>
<section id="comments"><p>Great article! says a reader in a long comment.</p></section></div>
<form><p>Mail</p></form><script>var a="<p>x</p>";</script><footer>foot</footer></body></html>"""


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("just text &amp; more <b>x</b>y", "just text & more xy"),
    (PAGE, "Head & line One twothree four. Long enough text of the article. Second para link with more text. a b"),
    ("<article><h1>H</h1>x<div class=ad>y</div>z<br>w</article>tail<footer>f", "H x z w"),
    ("<article><p><b>one<br><p>two</b></p></article><footer>&copy; x", "one two"),
    ("<main><p>a < b &lt; c</p><img src='a>b'><!-- <p>no</p> --><p hidden>h</p></main>", "a < b < c"),
    ("<nav><p>only a menu</p></nav>", ""), ("<article><p>cut off <a href='x", "cut off"),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
])
def test_main_text(page, text):
    assert maintext.main_text(page) == text


def test_main_text_without_article_keeps_the_dense_part():
    links = "".join(f"<li><a href='/{k}'>Section number {k}</a></li>" for k in range(30))
    body = " ".join(["A sentence of the story that goes on for a while."] * 20)
    page = f"<body><div><ul>{links}</ul></div><div><div><p>{body}</p><p>{body}</p></div></div></body>"
    assert maintext.main_text(page) == f"{body} {body}"


STORY = " ".join(["A sentence of the story that goes on for a while."] * 8)
TEASER = "<div class=cards><article><h3>Other news</h3><p>Short words of a card.</p></article></div>"


@pytest.mark.parametrize("story", [f"<div><p>{STORY}</p><p>{STORY}</p><p>{STORY}</p></div>", f"<div>{STORY}<br>{STORY}<br>{STORY}</div>"])
def test_an_article_elsewhere_does_not_replace_the_story(story):
    for page in (f"<body>{story}{TEASER}</body>", f"<body>{TEASER}<div>{story}</div></body>"):
        assert maintext.main_text(page).count(STORY) == 3


def test_articles_side_by_side_are_all_taken():
    parts = [f"Part {k}. {STORY}" for k in range(3)]
    page = "".join(f"<article><p>{p}</p><p>{p}</p></article>" for p in parts)
    text = " ".join(f"{p} {p}" for p in parts)
    assert maintext.main_text(f"<body>{page}<p>tail</p></body>") == text
    assert maintext.main_text(f"<body><div>{page}</div><p>tail</p></body>") == text
    uneven = f"<article><p>{STORY}</p><p>{STORY}</p><p>{STORY}</p></article><article><p>{STORY}</p></article>"
    assert maintext.main_text(f"<body>{uneven}</body>").count(STORY) == 4


ASIDE = "<div class=sidebar><p>Side words of the page.</p></div>"


@pytest.mark.parametrize("opening", [
    "<div class='layout has-sidebar'>", "<div id=page class=no-sidebar>", "<div class='widget-post-content'>", "<article class='no-comments'>",
    "<div class=widget>", "<div class='site-banner'><div class='x-widget-post'>"])
def test_names_do_not_take_the_story(opening):
    page = f"<body>{opening}<p>{STORY}</p><p>{STORY}</p>{ASIDE}{opening.count('<') * '</div>'}<div class=cookie-notice>We use them.</div></body>"
    assert maintext.main_text(page) == f"{STORY} {STORY}"


LONG = "".join(f"<div><p>Reader {k} writes more than the story has words. {'And more and more. ' * 60}</p></div>" for k in range(5))


@pytest.mark.parametrize("page", [
    f"<article><p>{STORY}</p><p>{STORY}</p></article><div class='comment-list'>{LONG}</div>",
    f"<article><p>{STORY}</p><p>{STORY}</p><div class='comment-list'>{LONG}</div></article>",
    f"<article><p>{STORY}</p><p>{STORY}</p><ul class=replies><li>{LONG}<li>{LONG}</ul></article>",
    f"<div><p>{STORY}</p><p>{STORY}</p></div><section class=comments>{LONG}</section>",
    f"<div><p>{STORY}</p><p>{STORY}</p></div><section id='comments-section'><article class=comment>{LONG}</article></section>",
    f"<div class='cookie-wall'>{LONG}</div><div><p>{STORY}</p><p>{STORY}</p></div>",
    f"<div class='post-with-comments'><p>{STORY}</p><p>{STORY}</p></div><div class='ad-slot'>{LONG}</div>",
    f"<div class='ads-enabled'><p>{STORY}</p><p>{STORY}</p></div><div class=sidebar>{LONG}</div>",
])
def test_comments_notices_and_adverts_stay_out_at_any_length(page):
    assert maintext.main_text(f"<body>{page}</body>") == f"{STORY} {STORY}"


def test_pages_of_nothing_but_boilerplate():
    for name in ("comments", "reply", "cookie-wall", "advert"):
        assert maintext.main_text(f"<body><div class={name}>{LONG}</div></body>") == ""
    assert maintext.main_text(f"<div class=widget><p>{STORY}</p></div><div class=menu>a b</div>") == STORY
    assert maintext.main_text("<div class=widget>a few words</div>") == "a few words"


@pytest.mark.parametrize("opening", ["<nav><a href=/>Home</a>", "<button>go", "<aside>x", "<header><h1>Site", "<ul class=menu><li><a href=/>x</a>", "<footer><p>f"])
def test_unclosed_boilerplate_ends_with_what_is_around_it(opening):
    assert maintext.main_text(f"<body><div>{opening}</div><article><p>{STORY}</p></article></body>") == STORY
    assert maintext.main_text(f"<body><div><div>{opening}</div></div><div><p>{STORY}</p><p>{STORY}</p></div></body>") == f"{STORY} {STORY}"


def test_a_form_around_the_page_is_no_form():
    page = f"<form id=f><div><input name=q><label>Search</label></div><div><article><p>{STORY}</p></article></div></form>"
    assert maintext.main_text(f"<body>{page}</body>") == STORY
    assert maintext.main_text(f"<body><form><p>{STORY}</p></form><div><p>{STORY} x</p></div></body>") == f"{STORY} x"


class Plain(HTMLParser):
    """Closed, well nested elements as [tag, children], texts as strings."""

    def __init__(self, page):
        super().__init__()
        self.open = [["html", []]]
        self.feed(page)

    def handle_starttag(self, tag, attributes):
        self.open[-1][1].append([tag, []])
        self.open.append(self.open[-1][1][-1])

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, text):
        self.open[-1][1].append(text)


def plainly(page):
    """Composite text density as its definition says, by plain recursion: the texts of the subtree with the largest sum and
    of its uncles from the threshold on."""
    body = Plain(page).open[0]

    def chars(n):
        return len("".join(n.split())) if isinstance(n, str) else sum(map(chars, n[1]))

    def link_chars(n):
        return 0 if isinstance(n, str) else chars(n) if n[0] == "a" else sum(map(link_chars, n[1]))

    def tags(n):
        return 0 if isinstance(n, str) else sum(1 + tags(c) for c in n[1] if not isinstance(c, str))

    def link_tags(n):
        return 0 if isinstance(n, str) else sum((c[0] == "a") + link_tags(c) for c in n[1] if not isinstance(c, str))

    def density(n):
        c, t, lc, lt = chars(n), max(1, tags(n)), max(1, link_chars(n)), max(1, link_tags(n))
        if not c:
            return 0
        base = math.log(c / max(1, c - link_chars(n)) * link_chars(n) + link_chars(body) / max(1, chars(body)) * c + math.e)
        return c / t * math.log(max(1, c / lc * t / lt) + 1e-9) / math.log(base + 1 + 1e-9)

    def summed(n):
        return sum(density(c) for c in n[1] if not isinstance(c, str)) or density(n) / 1000

    def below(n, way):
        yield n, way
        for c in n[1]:
            if not isinstance(c, str):
                yield from below(c, [*way, n])

    best, way = max(below(body, []), key=lambda x: summed(x[0]))
    threshold = min(map(density, [best, *way]))

    def text(n):
        return n if isinstance(n, str) else f" {''.join(map(text, n[1]))} "

    def shown(n):
        if n is best:
            return text(n)
        if not any(n is w for w in way):
            return text(n) if density(n) >= threshold else ""
        return " ".join(shown(c) for c in n[1] if not isinstance(c, str))

    return " ".join(shown(body).split())


def test_densities_equal_a_plain_computation():
    rng = random.Random(7)

    def block(depth):
        if depth == 0 or rng.random() < 0.3:
            words = " ".join(rng.choice(["story", "of", "words", "goes", "on", "a", "long"]) for _ in range(rng.choice([1, 4, 40, 120])))
            link = f"<a href='x'>{words[:rng.choice([5, 40, 400])]}</a>" if rng.random() < 0.4 else ""
            return f"<p>{words}</p>" if not link else f"<div>{link}</div>" if rng.random() < 0.5 else f"<div><p>{words}</p>{link}</div>"
        return "<div>" + "".join(block(depth - 1) for _ in range(rng.randint(1, 4))) + "</div>"

    pages = ["<body>" + "".join(block(4) for _ in range(rng.randint(1, 4))) + "</body>" for _ in range(150)]
    assert [maintext.main_text(p) for p in pages] == [plainly(p) for p in pages]


def test_text_right_in_an_ancestor_counts():
    page = f"<body>First. {STORY} <b>bold</b> on<br>and {STORY}<div><p>{STORY}</p><p>{STORY}</p></div>{STORY} {STORY} Last.<p>x</p></body>"
    assert maintext.main_text(page).startswith(f"First. {STORY} bold on and {STORY} {STORY} {STORY} {STORY} {STORY} Last.")


def test_pages_query(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit("clash"))
    got = maintext.extract(pages).collect()
    assert len(got) == pages.count()
    assert all(r["n_chars"] == len(r["text"]) > 0 and "<" not in r["text"] for r in got)
    assert maintext.extract(pages.limit(0)).count() == 0
    twice = maintext.extract(pages.limit(3).union(pages.limit(3))).collect()
    assert len(twice) == 6 and len({(r["page_id"], r["text"]) for r in twice}) == 3
