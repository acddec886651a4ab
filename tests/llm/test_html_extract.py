import pytest

from tessera.llm.html_extract import extract_main_text, main_text, parse, subtree_hashes


def text(html, template=frozenset(), min_words=5):
    page = parse(html)
    return main_text(page, subtree_hashes(page), set(template), min_words)


@pytest.mark.parametrize("html,want", [
    ("", ""),
    ("plain text &amp; more", "plain text & more"),
    ("<p>one<p>two<br>three", "one\ntwo three"),
    ("<body><nav>menu</nav><article><h1>T</h1><p>a  b\n c</p></article><footer>f</footer></body>", "T\na b c"),
    ("<article><p><b>bold<br><p>next &eacute;&#233;&#x41;</b></article>", "bold\nnext ééA"),
    ("<article>x<script>if (a<b) '</p>'</script><style>p{}</style><!-- c <p>no</p> -->y</article>", "xy"),
    ("<main><p>in</p></main><p>out</p>", "in"),
    ("<header><h1>Site</h1></header><div class='side-bar'>q</div><div id=sidebar>s</div><p>body</p>", "q\nbody"),
    ("<div class='cookie-notice'>c</div><div class=ad>a</div><form><input>f</form><p>body</p><aside>x</aside>", "body"),
    ("<article><p>text</p><section class='comments'><article class='comment'>me too</article></section></article>", "text"),
    ("<div class='page with-sidebar'><article><p>kept</p></article></div>", "kept"),
    ("<form id=aspnet><main><p>kept</p></main></form>", "kept"),
    ("<ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>", "one\ntwo\na b\nc"),
    ("<p hidden>no</p><p style='display: none'>no</p><div role=navigation>no</div><p>yes", "yes"),
    ("<title>t</title><p>a<textarea>x</textarea>", "a"),
    ("<p class=\"unclosed>x</p><p>rest</p>", "x\nrest"),
    ("<" * 50 + "p>1 < 2 &unknown; &lt;b&gt;", "<" * 49 + "\n1 < 2 &unknown; <b>"),
])
def test_pages(html, want):
    assert text(html) == want


def test_deep_nesting():
    assert text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, text string")


def test_templates_of_a_host_are_deleted(spark):
    note = "<p>Read our other five stories on this topic today</p>"
    box = "<div class='q7'><span>Great offers</span> and more every day</div>"

    def page(i):
        return f"<body><div>{box}<p>Story {i} begins here and tells {i * 7} things</p>{note}<p>It ends with {i * 13} words.</p></div></body>"

    def marked(i):
        return f"<body>{box}<article><p>Story {i} begins here and tells {i * 7} things of note to all of us</p>{note}<p>End {i}.</p></article></body>"

    rows = [(f"https://a.example/{i}", page(i)) for i in range(30)] + [(f"http://www.b.example/{i}", marked(i)) for i in range(30)]
    rows += [("https://c.example/1", page(1))]
    got = {r.page_id: r.text for r in extract_main_text(pages_of(spark, rows)).collect()}
    assert got[3] == "Story 3 begins here and tells 21 things\nIt ends with 39 words."
    assert got[33] == "Story 3 begins here and tells 21 things of note to all of us\nEnd 3."
    assert "Great offers" in got[60] and "other five stories" in got[60]  # one page is no site


def test_copies_of_an_article_are_no_template(spark):
    copy = "<body><nav>n</nav><article><h1>One story</h1><p>It was copied many times over on this host.</p><p>Still it is no template.</p></article></body>"
    near = ["<body><article><p>A long paragraph that all of the near copies share, word by word by word.</p>"
            f"<p>And one of their own: {i}</p></article></body>" for i in range(40)]
    got = extract_main_text(pages_of(spark, [("https://a.example/", copy)] * 40 + [("https://b.example/", n) for n in near])).collect()
    assert {r.text for r in got if "a.example" in r.url} == {"One story\nIt was copied many times over on this host.\nStill it is no template."}
    assert all(r.text.count("\n") == 1 for r in got if "b.example" in r.url)


def test_odd_rows(spark):
    rows = [(None, None), ("", ""), ("not a url", "<p>x"), ("https://a.example/", "<p>" + "long word " * 100_000), ("https://a.example/", "\ud83d")][:4]
    got = {r.page_id: r.text for r in extract_main_text(pages_of(spark, rows + [(None, None)])).collect()}
    assert got[0] == got[1] == got[4] == "" and got[2] == "x" and len(got[3]) == 999_999
    assert extract_main_text(pages_of(spark, rows).limit(0)).count() == 0


def test_a_shared_passage_of_articles_stays(spark):
    shared = "<p>Terms of this kind are quoted by many of our stories</p>"
    box = "<div class='q7'>Great offers and more every day</div>"

    def page(i, core, share):
        body = [f"<p>Story {i} tells {i * k} things of note to all of us</p>" for k in range(1, 5)]
        if i % 100 < share:
            body.insert(i % 4, shared)
        return f"<body>{box}<{core}><h1>Story {i}</h1>{''.join(body)}</{core.split()[0]}></body>"

    # on 11% of a large host, and on all pages but in changing places
    hosts = {"a": ("article", 11), "b": ("main", 11), "c": ("div role='main'", 11), "d": ("article", 100)}
    rows = [(f"https://{h}.example/{i}", page(i, *how)) for h, how in hosts.items() for i in range(200)]
    rows += [(f"https://e.example/{i}", page(i, "div", 11)) for i in range(200)]
    got = extract_main_text(pages_of(spark, rows)).collect()
    count = lambda word: {h: sum(word in r.text for r in got if f"/{h}." in r.url) for h in "abcde"}
    assert count("Terms of this kind") == {"a": 22, "b": 22, "c": 22, "d": 200, "e": 0}
    assert not any(count("Great offers").values())


@pytest.mark.parametrize("inner,want", [
    ("<section id='discussion'><p>kept</p></section>", "kept"),
    ("<h2 id='related-work'>Related work</h2><p>kept</p>", "Related work\nkept"),
    ("<div class='form-factor'>kept</div><div class='social-history'>too</div><li class='skip-list'>three</li>", "kept\ntoo\nthree"),
    ("<div class='section' id='comments'>kept</div><p id=search class=notice>too</p>", "kept\ntoo"),
    ("<pre>a <span class='comment'># kept</span></pre>", "a # kept"),
    ("<p>text</p><div class='post comments'>c</div><ul class=share-buttons><li>s</ul><div class='ad-slot x'>a</div><div id=disqus_thread>d</div>", "text"),
])
def test_names_inside_an_article(inner, want):
    assert text(f"<article>{inner}</article>") == want
    assert text(f"<nav>n</nav><main>{inner}</main>") == want


@pytest.mark.parametrize("html,want", [
    ("<body><h1 id=comment-on-a-paper>T</h1><section id=discussion>kept</section><section id=comments>c</section></body>", "T\nkept"),
    ("<article class='post tag-ads category-promo' id=reply-to-critics>kept</article>", "kept"),
    ("<div class='discussion'><article class='masthead-image'>kept</article></div>", "kept"),
    ("<main id='search-header'>kept</main>", "kept"),
    ("<article>kept</article><div class='related'><article>teaser</article></div>", "kept"),
])
def test_names_outside(html, want):
    assert text(html) == want


def test_counts_decide_on_names_inside_an_article(spark):
    def page(i):
        note = "<div class='notice'>All rights kept</div>" if i % 3 == 0 else f"<div class='notice'>Note {i}</div>"
        body = [f"<p>Story {i} tells {i * k} things of note to all of us</p>" for k in range(1, 5)]
        body.insert(i % 5, note)
        return f"<article>{''.join(body)}</article>"

    got = extract_main_text(pages_of(spark, [(f"https://a.example/{i}", page(i)) for i in range(90)])).collect()
    assert not any("All rights" in r.text for r in got)
    assert sum(f"Note {r.page_id}\n" in r.text + "\n" for r in got) == 60


LONG = "A story of many words that goes on and on for a good while yet."


@pytest.mark.parametrize("html,want", [
    (f"<main><h1>T</h1><p>{LONG}</p><article class='card'>teaser</article></main>", f"T\n{LONG}\nteaser"),
    (f"<div role='main'><p>{LONG}</p><article>teaser</article></div>", f"{LONG}\nteaser"),
    (f"<main><p>{LONG}</p></main><article class='card'>teaser</article>", LONG),
    (f"<main><p>See below now</p></main><article><p>{LONG}</p></article>", f"See below now\n{LONG}"),
    (f"<main><p>Home</p><article><p>{LONG}</p></article></main>", LONG),
    (f"<main><article><p>{LONG}</p><article>nested</article></article></main>", f"{LONG}\nnested"),
    (f"<body><nav>n</nav><h1>T</h1><p>{LONG}</p><article class='teaser'>short teaser</article></body>", f"T\n{LONG}\nshort teaser"),
    (f"<body><p>Top line</p><article>{LONG}</article><ul>{'<li><a>link to more</a>' * 9}</ul></body>", LONG),
    (f"<main></main><article></article><p>{LONG}</p>", LONG),
])
def test_the_bulk_of_the_live_text_is_main(html, want):
    assert text(html) == want


def test_templates_of_pages_with_both(spark):
    box = "<div class='q7'>Great offers and more every day</div>"
    shared = "<p>Terms of this kind are quoted by many of our stories</p>"
    card = "<article class='card'><p>One shared teaser of the host's front page story</p></article>"
    pages = [f"<body>{box}<p>Story {i} tells {i * 7} things. {LONG}</p>{card}</body>" for i in range(30)]
    pages += [f"<main>{shared if i % 5 == 0 else ''}<p>Story {i} tells {i * 7} things. {LONG}</p><article>Teaser {i}</article></main>"
              for i in range(100)]
    pages += [f"<body>{box}<p>Story {i} tells {i * 7} things. {LONG}</p><article>Teaser {i}{shared if i % 5 == 0 else ''}<p>{LONG} {i}</p></article></body>"
              for i in range(100)]
    rows = [(f"https://{'a' if i < 30 else 'b' if i < 130 else 'c'}.example/{i}", p) for i, p in enumerate(pages)]
    got = [r.text for r in extract_main_text(pages_of(spark, rows)).orderBy("page_id").collect()]
    assert all(f"tells {(i if i < 30 else (i - 30) % 100) * 7} things" in t and "Great offers" not in t for i, t in enumerate(got))
    assert [sum("Terms of this kind" in t for t in got[a:b]) for a, b in ((0, 30), (30, 130), (130, 230))] == [0, 20, 20]


@pytest.mark.parametrize("html,want", [
    ("<article><p>Let <math><mi>x</mi><annotation encoding='application/x-tex'>\\\\x</annotation></math> hold.</p><label>Note</label></article>", "Let x hold.\nNote"),
    ("<article><p class=ad>a</p><p>kept <span class=advert>a</span></p><table class=ad><tr><td>a</table><details class=comments>c</details></article>", "kept"),
    ("<body><div class='search-results-article'>kept</div><div id=discussion>two</div><div class='social-history'>three</div></body>", "kept\ntwo\nthree"),
    ("<body><div class='site-header'>h</div><div class='comments'>c</div><div id=footer>f</div><p>kept</p></body>", "kept"),
])
def test_text_that_only_sounds_like_furniture_stays(html, want):
    assert text(html) == want


def test_recurring_words_of_unmarked_pages_stay(spark):
    """A heading on one page in eight, a label on one in six and the cells of a table are no templates; a menu is."""
    menu = "<div><div>Home</div><div>News</div><div>Sports</div><div>Weather</div><div>Contact</div></div>"

    def page(i):
        told = [f"<p>Story {i} tells {i * k} things of note to all of us</p>" for k in range(1, 5)]
        head = "<h2>Summary</h2>" if i % 8 == 0 else ""
        note = f"<p><b>Note:</b> number {i}</p>" if i % 6 == 0 else ""
        return f"<body>{menu}{head}{told[0]}{note}<table><tr><td>{'Yes' if i % 2 else 'No'}<td>{i}</table>{''.join(told[1:])}</body>"

    got = {r.page_id: r.text for r in extract_main_text(pages_of(spark, [(f"https://a.example/{i}", page(i)) for i in range(200)])).collect()}
    for i, t in got.items():
        want = ["Summary"] * (i % 8 == 0) + [f"Story {i} tells {i} things of note to all of us"] + [f"Note: number {i}"] * (i % 6 == 0)
        want += [f"{'Yes' if i % 2 else 'No'} {i}"] + [f"Story {i} tells {i * k} things of note to all of us" for k in range(2, 5)]
        assert t == "\n".join(want), i


def test_templates_are_those_of_a_plain_count(spark):
    """The subtrees of unmarked pages that a host repeats, counted in one process."""
    import random
    from collections import defaultdict

    from tessera.llm.html_extract import site_templates

    rng = random.Random(2)
    parts = [f"<p>shared paragraph number {k} of this site</p>" for k in range(12)]
    rows = [(f"https://{'a' if i % 3 else 'b'}.example/{i}", "<body>" + "".join(p for k, p in enumerate(parts) if rng.random() < 0.02 * (k + 1))
             + f"<p>own words {i % 70} of page</p></body>") for i in range(180)]
    seen, mains = defaultdict(set), defaultdict(set)
    for url, html in rows:
        page = parse(html)
        hashes = subtree_hashes(page)
        host, body = url[8:17], hashes[page.tag.index("body")]
        mains[host].add(body)
        for i, h in enumerate(hashes):
            if page.tag[i] == "p":
                seen[host, h].add(body)
    want = {(host, h) for (host, h), pages in seen.items() if len(pages) >= max(10, 0.1 * len(mains[host]))}
    df = pages_of(spark, rows).selectExpr("substring(url, 9, 9) AS host", "html")
    got = {(r.host, h & 0xFFFFFFFFFFFFFFFF) for r in site_templates(df, 10, 0.1, 0.9).collect() for h in r.template}
    assert got == want and len(want) > 5
