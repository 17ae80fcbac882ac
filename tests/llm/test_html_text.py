"""Main-text extraction on small pages, well formed and not."""

from churnlens.llm.html_text import composite_density, extract, main_text

PROSE = "A long enough sentence of plain article prose, with commas and a point. "


def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_article_without_furniture():
    p = page(f"""<nav><ul><li><a href=/x>Menu</a></li></ul></nav><!-- note --><div class="ad">Buy {PROSE}</div>
      <div id=cookie-notice>{PROSE}</div><article><h1>Head &amp; line</h1><p><b>One {PROSE}<br><p>Two&nbsp; {PROSE}
      <script>var x="<p>no</p>";</script><form><p>Ask</p></form><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>
      <aside>{PROSE}</aside><section class="comments"><p>{PROSE * 9}</p></section><footer>&copy; f</footer>""")
    s = PROSE.strip()
    assert main_text(p).split("\n") == ["Head & line", f"One {s}", f"Two {s}", "a", "b", "c", "d"]


def test_article_in_plain_divisions():
    p = page(f"""<div class=top><a href=1>one</a> <a href=2>two</a> <a href=3>three</a></div>
      <div><div><p>{PROSE * 3}</p><p>{PROSE * 2}</p><p>Short end.</p></div></div><div class=x><a href=4>four {PROSE}</a></div>""")
    assert main_text(p).split("\n") == [(PROSE * 3).strip(), (PROSE * 2).strip(), "Short end."]


def test_every_part_of_an_article_without_an_element():
    texts = [f"{w} " + "word and words " * 13 for w in "abcdefgh"]
    ps = [f"<p>{t}</p>" for t in texts]
    want = [t.strip() for t in texts]
    menu = "<div class=top><a href=1>one</a> | <a href=2>two</a> | <a href=3>three</a></div>"
    column = "<div class=col><div class=txt>{}</div></div>"
    for box in (column, "<div><div>{}</div></div>", "<section>{}</section>"):
        two = box.format("".join(ps[:4])) + box.format("".join(ps[4:]))
        assert main_text(page(f"{menu}<div class=row>{two}</div>{menu}")).split("\n") == want
        assert main_text(page(f"{menu}{two}{menu}")).split("\n") == want
    long = "".join(ps)
    for box in ("<section>{}</section>", "<div class=part>{}</div>", "<div>{}</div>"):
        got = main_text(page(f"{menu}<div id=content><h1>Title</h1><p>A short intro of the text.</p>{box.format('<h2>One</h2>' + long)}<hr>"
                             f"<h2>Between</h2>{box.format('<h2>Two</h2><p>A short end.</p>')}<p>Last words.</p></div>{menu}"
                             "<div class=legal><p>Some rights.</p></div>"))
        assert got.split("\n") == ["Title", "A short intro of the text.", "One", *want, "Between", "Two", "A short end.", "Last words."]
    for box in ("<div>{}</div>", "<div class=part>{}</div>"):
        two = box.format(long) + box.format("<p>A short end.</p>")
        assert main_text(page(f"{menu}<div id=content>{two}</div><div id=legal><p>Some rights.</p></div>")).split("\n") == [*want, "A short end."]
    # far apart, a linked wrapper around the second half, a teaser between, loose text
    got = main_text(page(f"<div><div><div>{''.join(ps[:4])}</div></div></div><div><a href=1>{'teaser ' * 9}</a></div><div>By me</div>"
                         f"<div><div><a href=2>{'link ' * 400}</a></div><div>{''.join(ps[4:])}</div></div>"))
    assert got.split("\n") == want[:4] + ["By me"] + want[4:]
    got = main_text(page(f"{menu}<div>{texts[0]}<b>bold</b> end<div>{''.join(ps[1:])}</div>Short.</div>"))
    assert got.split("\n") == [f"{texts[0]}bold end", *want[1:], "Short."]


def test_names_of_layout_and_header_blocks():
    s = PROSE.strip()
    assert main_text(page(f"<div class='content with-sidebar'><article><div class=article-header><h1>T</h1></div><p>{PROSE}</p>"
                          f"</article><div class=sidebar><p>{PROSE}</p></div></div>")).split("\n") == ["T", s]
    assert main_text(page(f"<div class='layout-sidebar'><p>{PROSE}</p><p>{PROSE}</p><div class=ad>{PROSE}</div></div>"
                          "<div class=x><a href=1>y</a></div>")).split("\n") == [s, s]
    assert main_text(page(f"<article><p>Short.</p></article><div class=ad>{PROSE * 9}</div>")) == "Short."


def test_attributes_are_read_by_their_names():
    s = PROSE.strip()
    for attrs in ("style='overflow:hidden'", 'aria-hidden="false"', 'data-state="not hidden"', "data-id=sidebar data-role=navigation",
                  "title='id=ads class=menu role=banner'", "data-hidden", "class='a' class='ad'"):
        assert main_text(page(f"<article {attrs}><p>{PROSE}</p></article>")) == s, attrs
        assert main_text(page(f"<article><div {attrs}><p>{PROSE}</p></div><section {attrs}><p>{PROSE}</p></section></article>")) == f"{s}\n{s}"
        assert main_text(f"<html><body {attrs}><p>{PROSE}</p></body></html>") == s, attrs
    for attrs in ("hidden", "HIDDEN", "hidden=''", "class=x hidden", 'aria-hidden="true"', "role='Navigation'", "class='x &#97;d'"):
        assert main_text(page(f"<article><p>{PROSE}</p><div {attrs}><p>No {PROSE}</p></div></article>")) == s, attrs
    assert main_text(f"<html><body aria-hidden=true><p>{PROSE}</p></body></html>") == s


def test_names_that_are_no_furniture():
    s = PROSE.strip()
    names = ("discussion", "related-work", "recommendations", "social-history", "naval-history", "shareholders", "side-effects", "notice")
    for box in ("article", "main"):
        for name in names:
            got = main_text(page(f"<{box}><h1>T</h1><p>{PROSE}</p><section id={name}><h2 id={name}>H <span id={name}>I</span></h2><p id={name}>{PROSE}</p>"
                                 f"</section><div class=section id={name}><p>{PROSE}</p></div></{box}>"))
            assert got.split("\n") == ["T", s, "H I", s, s], (box, name)
    for name in names[1:2] + names[3:7]:
        got = main_text(page(f"<article><p>{PROSE}</p><section class={name} aria-label='{name}'><p class={name}>{PROSE}</p></section>"
                             f"<div class={name}><p>{PROSE}</p></div></article>"))
        assert got.split("\n") == [s] * 3, name
    for name in names[:6]:  # the same without an article element
        got = main_text(page(f"<div><section><h2 id={name}>H</h2><p>{PROSE}</p></section><section id={name}><p id={name}>{PROSE}</p></section></div>"))
        assert got.split("\n") == ["H", s, s], name
    for name in ("comments", "related-posts", "share", "ad-slot-3", "sidebar", "cookie-notice", "navbar", "socialIcons", "sponsored", "newsletter-box"):
        for where in ("<article><p>{0}</p>{1}</article>", "<article><p>{0}</p></article>{1}", "<div><div><p>{0}</p><p>{0}</p></div></div>{1}"):
            for tag in ("section", "div"):
                got = main_text(page(where.format(PROSE, f"<{tag} class={name}><p>No {PROSE}</p></{tag}>")))
                assert set(got.split("\n")) == {s}, (name, where, tag)


def test_form_around_the_page():
    s = PROSE.strip()
    inner = f"<div class=top><a href=1>one</a></div><div><h1>T</h1><p>{PROSE}</p><p>{PROSE}</p><select><option>x</select></div>"
    assert main_text(page(f"<form id=aspnetForm role=form>{inner}</form>")).split("\n") == ["T", s, s]
    assert main_text(page(f"<form><main>{inner}</main></form>")).split("\n")[-3:] == ["T", s, s]
    assert main_text(page(f"<main><form><p>{PROSE}</p><p>{PROSE}</p></form></main>")).split("\n") == [s, s]
    assert main_text(page(f"<article><p>{PROSE}</p><form><p>Ask</p></form></article><form hidden><p>{PROSE * 9}</p></form>")) == s


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<html></html>") == ""
    assert main_text("just words") == "just words"
    assert main_text("<p>unclosed <b>bold <p>next &lt;x&gt;") == "unclosed bold\nnext <x>"
    assert main_text("<article><p>a</p></article") == "a"
    deep = "<div>" * 3000 + "<p>deep text</p>"
    assert main_text(deep) == "deep text" == main_text(deep.replace("<div>", "<div class=sidebar>"))
    assert main_text("<article><header>By me</header><p>x y</p></article><header>Site</header>") == "By me\nx y"
    assert len(main_text("<article>" + "<p>word and word</p>" * 20000 + "</article>")) == 20000 * 14 - 1


def test_density_prefers_prose_to_links():
    assert composite_density(1000, 5, 10, 1, 0.1) > composite_density(1000, 50, 900, 40, 0.1) > 0
    assert composite_density(0, 3, 0, 0, 0.0) == 0.0 == composite_density(50, 3, 50, 3, 0.5)


def test_rows(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>hé</p>", "y"), (3, "u", "<p>a</p>", "y"), (3, "u", "<p>a</p>", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string")
    assert sorted(map(tuple, extract(df).collect()), key=str) == sorted(
        [(1, "u", "", 0), (2, None, "", 0), (None, "u", "hé", 2), (3, "u", "a", 1), (3, "u", "a", 1)], key=str)
    assert extract(df.limit(0)).count() == 0
