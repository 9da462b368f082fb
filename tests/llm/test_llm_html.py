from conftest import SF01


from quarry.llm import html

TREE = html.grow(html.labelled_rows())


def text(page):
    return html.main_text(page, TREE)


def test_tree_fits_its_table_and_uses_the_neighbours():
    rows = html.labelled_rows()
    assert sum(html.decide(TREE, x) == y for x, y in rows) >= len(rows) - 1
    assert len(rows[0][0]) == len(html.FEATURES)

    def used(t):
        return set() if isinstance(t, int) else {html.FEATURES[t[0]]} | used(t[2]) | used(t[3])
    assert used(TREE) >= {"holder", "words", "links"} and len(used(TREE) & {"words_before", "words_after", "links_before", "links_after"}) >= 2


def test_article_without_its_surroundings():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad --><div class="ad">Buy this now, dear reader</div>
<div id="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>One   two<br>three <b>bo</b>ld &eacute;&#33;
<p>Unclosed paragraph with a <a href="x">link</a>.</p><form><input><label>Mail</label></form><aside>More</aside>
<div class="share-buttons">Share</div><p>x</p><section id="comments"><p>First!</p></section></article><aside><p>Side</p></aside>
<footer>&copy; me</footer></body></html>"""
    assert text(page) == "Head & line\n\nOne two three bold é!\n\nUnclosed paragraph with a link.\n\nx"


def test_pages_without_article_go_by_density():
    para = "A sentence of a reasonable length that stands in the middle of the page and has no link in it at all."
    page = f"<ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul><div><p>{para}</p><p>{para}</p><p>Short one.</p><p>{para}</p></div><p><a href=3>Next</a></p>"
    assert text(page) == "\n\n".join([para, para, "Short one.", para])


def test_broken_pages():
    assert text(None) == text("") == text("<nav><a href=x>y") == text("<script>never closed") == text("<!-- open") == ""
    assert text("<article><p>cut off in the midd") == "cut off in the midd"
    assert text('<article><p title="a > b" class=x>kept</p><p title="open>still there</p></article>').startswith("kept")
    assert text("<nav><li>menu<article><p>inside</p></article><footer>foot") == "inside"
    assert text("</div></p><article>a &lt;b&gt; &unknown; &#0; c</article>").startswith("a <b> &unknown;")
    assert text("<article>1 < 2 and 3 > 2</article>") == "1 < 2 and 3 > 2"
    assert text("<article><p>" + "word " * 200_000 + "</p></article>") == " ".join(["word"] * 200_000)


def test_rows_in_rows_out(spark):
    rows = [(1, "u", "<article>a</article>"), (1, "u", "<article>a</article>"), (2, None, None), (None, "v", ""), (3, "w", "<p>")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in html.extract(pages).collect())
    assert got == [(0, "v", "", 0), (1, "u", "a", 1), (1, "u", "a", 1), (2, "", "", 0), (3, "w", "", 0)]
    assert html.extract(pages.limit(0)).collect() == []


def test_articles_of_the_table(spark):
    import html as std
    import re
    got = {r.page_id: r.text for r in html.op4_html(spark, SF01).collect()}
    for r in spark.read.parquet(f"{SF01}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer|\Z)", r.html, re.S).group(1)
        parts = (" ".join(std.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        assert got[r.page_id] == "\n\n".join(p for p in parts if p)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_wrappers_and_partial_class_names():
    a, b = "first paragraph " * 30, "second paragraph " * 25
    want = f"{a.strip()}\n\n{b.strip()}"
    menu = "<nav><a href=1>Home</a> <a href=2>News</a></nav>"
    assert text(f"{menu}<form id='aspnetForm' action='x'><div><p>{a}</p><p>{b}</p></div></form>") == want
    assert text(f"{menu}<div class='content has-sidebar'><p>{a}</p><p>{b}</p></div><footer>me</footer>") == want
    assert text(f"{menu}<div class='no-comments single'><p>{a}</p><p>{b}</p></div>") == want
    assert text(f"<article><p>{a}</p><p>{b}</p><form>Mail <input></form></article>") == want
    assert text(f"<article><p>{a}</p><p>{b}</p></article><div class='site-footer wide'><p>about us</p></div><div id=comments><p>{a * 9}</p></div>") == want


def test_lists_of_links_in_an_article_go_and_single_links_stay():
    p = "a paragraph of the article with quite a few words in it and no link at all"
    links = "".join(f"<p><a href={i}>Related story number {i}</a></p>" for i in range(5))
    assert text(f"<article><h1>T</h1><p>{p}</p><div>{links}</div><p>{p}</p></article>") == f"T\n\n{p}\n\n{p}"
    assert text(f"<article><p>{p}</p><p><a href=1>The source</a></p><p>{p}</p></article>") == f"{p}\n\nThe source\n\n{p}"


def test_generated_pages_without_an_article():
    import random
    rng, right, blocks, below = random.Random(8), 0, 0, 0
    for _ in range(150):
        def links(n):
            return "".join(f"<li><a href=x>{words(rng, rng.randrange(1, 5))}</a></li>" for _ in range(n))
        want, body = [], []
        title = words(rng, rng.randrange(2, 8))
        want.append(title)
        for _ in range(rng.randrange(3, 9)):
            kind = rng.random()
            p = words(rng, rng.randrange(15, 90) if kind < 0.8 else rng.randrange(9, 15))
            if rng.random() < 0.3:
                first, rest = p.split(" ", 2)[:2], p.split(" ", 2)[2]
                body.append(f"<p><a href=y>{' '.join(first)}</a> {rest}</p>")
            else:
                body.append(f"<p>{p}</p>")
            want.append(p)
        last = words(rng, rng.randrange(20, 60))
        page = (f"<html><body><div class=top><ul>{links(rng.randrange(3, 9))}</ul></div><div class=wrap><h1>{title}</h1>{''.join(body)}<p>{last}</p></div>"
                f"<div class=more><ul>{links(rng.randrange(3, 12))}</ul></div><div>{words(rng, rng.randrange(2, 8))}</div></body></html>")
        right += text(page) == "\n\n".join([*want, last])
        found = html.blocks(page)
        blocks += len(found)
        below += sum(b[3] == 0 for b in found)
    assert right >= 0.95 * 150 and below >= blocks / 2
