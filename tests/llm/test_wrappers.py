import html
import random
import tracemalloc

from ledgerflow.llm.wrappers import align, as_items, extract, infer, item_key, main_text, matches, parse

PAGE = """<!DOCTYPE html><html><head><title>{t}</title><style>p{{}}</style><script>var x="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">{t}</a></li><li>b</li></ul></nav><!-- ad --><div class="ad-box">{t} buy</div>
<article><h1>{t}</h1>{body}</article><div id="comments"><p>first {t}</p></div><footer>&copy; {t}</footer></body></html>"""


def page(k, paragraphs):
    return PAGE.format(t=f"Title &amp; {k}", body="".join(f"<p>{html.escape(p)}</p>" for p in paragraphs))


def keys(items):
    return [item_key(i) + "?" * bool(i.get("opt")) + "+" * bool(i.get("rep")) for i in items]


def test_union_free_expression():
    a, b = as_items(parse("<h2>x</h2><p>1<p>2<hr>")), as_items(parse("<h2>y</h2><div>z</div><p>1"))
    assert keys(align(a, b)) == ["h2", "div?", "p+", "hr?"]
    assert [i["c"][0]["t"] is None for i in align(a, b) if item_key(i) == "h2"] == [True]
    pairs = as_items(parse("<dl><dt>a<dd>1<dt>b<dd>2</dl>"))
    assert keys(pairs[0]["c"]) == ["(dt dd)+"]


def test_blocks_references_and_white_space():
    got = extract("""<main><h2>T &amp; U&nbsp;</h2><p>One <em>two</em>
      three<p>Four<br>five &lt;b&gt; &#233;<ul><li>a<li>b</ul><form><input>x</form><div class=share>Tweet</div></main><p>out""", [])
    assert got == "T & U\nOne two three\nFour five <b> é\na\nb"
    assert extract("<article><p>cut he", []) == "cut he" and extract("<article><p>x &amp", []) == "x &"
    assert extract("<div>" * 5000 + "deep", []) == "deep"


def test_template_texts_without_a_main_container():
    made = [f"<div class=top>Site name</div><div id=c><p>text {k}</p><p>tail {k}</p></div><div class=foot>All rights</div>" for k in range(4)]
    assert extract(made[0].replace("text 0", "new"), infer(made)) == "new\ntail 0"
    assert extract(made[0], infer(made[:1])) == "Site name\ntext 0\ntail 0\nAll rights"


def test_pages(frame):
    rows, want = [], {}
    for k in range(40):
        text = [f"Body {k} of {j} & <more>" for j in range(k % 5)]
        rows.append((k, f"https://{'hot' if k % 3 else f'h{k}'}.example.com/x?{k}", page(k, text), "w"))
        want[k] = "\n".join([f"Title & {k}", *text])
    rows += [(100, "https://hot.example.com/", None, "w"), (101, None, "", "w"), (102, "no url", "plain &eacute;", "w"),
             (103, "https://hot.example.com/", page(103, ["long " * 100_000]), "w"), (5, rows[5][1], rows[5][2], "w")]
    want |= {100: "", 101: "", 102: "plain é", 103: "Title & 103\n" + ("long " * 100_000).strip()}
    df = frame(rows, "page_id long, url string, html string, wrapper string")
    got = main_text(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)
    assert main_text(df.limit(0)).collect() == []


def test_nothing_of_the_article_is_dropped_for_being_shared():
    made = [f"<body><article><h1>T {k}</h1><h2>Summary</h2><p>text {k}</p></article></body>" for k in range(4)]
    assert extract(made[1], infer(made)) == "T 1\nSummary\ntext 1"
    same = [f"<div>{k}</div><article><p>One text</p></article>" for k in range(4)]
    assert extract(same[0], infer(same)) == "One text"


def test_attributes_as_html_has_them():
    assert extract("<article><p title=it's>Hello</p><p>It's World</p><p>x</p></article>", []) == "Hello\nIt's World\nx"
    assert extract("<article><p title=it's>one apostrophe</p></article>", []) == "one apostrophe"
    assert extract("<article><p data-x='a>b' title=\"class=ad\">kept</p><div class=ad>gone</div><p =odd / x = \"y\" z>end</article>", []) == "kept\nend"
    assert extract("<article><p>before</p><p title=\"never closed>rest</p></article>", []) == "before"
    assert extract("<article>" + "<p a=b " * 3000 + ">x</article>", []) == "x"


def test_a_text_of_one_page_only_is_not_the_templates():
    made = [f"<div class=top>Site name</div><div class=c>text {k}</div>" + "<h2>Only here</h2>" * (k == 2) for k in range(6)]
    assert extract(made[2], infer(made)) == "text 2\nOnly here"


def test_words_of_slugs_and_of_containers_leave_nothing_out():
    for name in ("<body class='has-sidebar'><article>", "<body class=sidebar><article>", "<article class='no-sidebar'>", "<article class='post comment'>",
                 "<main id='search-results'>", "<main id=search>", "<div class='widget page'><div id=login><main>", "<html class=overlay><main>",
                 "<main><div data-id=search>"):
        assert extract(name + "<h2>T</h2><p>text", []) == "T\ntext"
    inner = "<article><h2 id='social-history'>A</h2><h3 id=search>B</h3><section id='related-work'>C</section><section id=search>D</section>" \
        "<div class='skip-none'>E</div><div class='box share'>x</div><div id=comments>x</div><div role='banner'>x</div></article>"
    assert extract(inner, []) == "A\nB\nC\nD\nE"
    assert extract("<main><p>text</main><div class=comments><article>first</article></div>", []) == "text"
    assert extract("<div class=sidebar>x</div><div class=page><div class=ad>y</div><p>text</div>", []) == "text"


def test_all_pages_of_a_host_count(frame):
    """A late block of the template stands on 3 of 300 pages, a page repeats 90 times, dealt in any way."""
    made = {k: f"<div class=top>Site name</div><div class=c>text {k}</div>" + "<div class=late>Moved to a new address</div>" * (k % 100 == 7)
            for k in range(300)}
    rows = [(k, "http://a.example/", p) for k, p in made.items()] + [(7, "http://a.example/", made[7])] * 90
    rows += [(1000 + k, "http://b.example/", "<div class=top>Only twice</div>" + f"<p>{k % 2}</p>") for k in range(200)]
    for parts in (2, 7):
        df = frame(rows, "page_id long, url string, html string", parts)
        got = main_text(df).collect()
        assert len(got) == len(rows)
        assert all(r.text == (f"text {r.page_id}" if r.page_id < 1000 else f"Only twice\n{r.page_id % 2}") for r in got)


def test_text_after_and_below_a_deep_nest():
    deep = "<div>" * 3000
    nest = f"{deep}in<nav>menu</nav><form>f</form><div class=ad>buy</div><p>low{'</div>' * 3000}"
    page = f"<div><article><h1>T</h1>{nest}<p>after</article></div><p>outside"
    assert extract(page, []) == "T\nin\nlow\nafter"
    made = [f"<div><article><h1>T {k}</h1>{nest}<p>after {k}</article></div><p>outside" for k in range(4)]
    assert extract(made[3], infer(made)) == "T 3\nin\nlow\nafter 3"
    assert extract(f"<p>x</p>{deep}<div class=widget><main>text</main>", []) == "text"
    assert extract("<div>" * 100_000 + "</p>" * 100_000 + "end", []) == "end"


def test_matches_are_a_longest_common_subsequence_in_little_memory():
    def table(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
        return best[0][0]

    rnd = random.Random(5)
    for _ in range(300):
        a, b = ([rnd.choice("abcdefghijkl"[:rnd.randint(1, 12)]) for _ in range(rnd.randint(0, 40))] for _ in range(2))
        got = matches([{"k": x} for x in a], [{"k": x} for x in b])
        assert len(got) == table(a, b) and all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
    a, b = ([{"k": f"k{rnd.randrange(40)}"} for _ in range(20_000)] for _ in range(2))
    tracemalloc.start()
    assert len(matches(a, b)) > 4_000
    assert tracemalloc.get_traced_memory()[1] < 50 << 20
    tracemalloc.stop()
