import math
import random

import pytest

from cratemark.llm import htmltext
from cratemark.llm.htmltext import main_text

ARTICLE = (
    "<article><h1>A title &amp; more</h1><p><b>First  paragraph,\n with <a href=x>a link</a> in it.<br>"
    "<p>Second &lt;p&gt; paragraph&nbsp;here.</p></article>"
)
TEXT = "A title & more\nFirst paragraph, with a link in it.\nSecond <p> paragraph here."
PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>'
    "<nav><ul><li><a href=/a>Home page</a></li></ul></nav><!-- <p>no</p> --><div class='ad'>Buy this</div>{}"
    "<section id='comments'><p>A reader says that this is very good indeed.</p></section>"
    "<form><p>Your name</p><input></form><aside><p>See also</p></aside><footer>&copy; us</footer></body></html>"
)


def test_article_without_the_rest():
    assert main_text(PAGE.replace("{}", ARTICLE)) == TEXT


def test_density_finds_the_text_without_an_article_element():
    body = "".join(f"<p>{'Some words of a paragraph ' * 4}{i}.</p>" for i in range(6))
    links = "<div>" + "".join(f"<div><a href=/{i}>link number {i}</a></div>" for i in range(30)) + "</div>"
    found = main_text(f"<body>{links}<div><h1>Head</h1><div>{body}</div></div><div>short</div></body>")
    assert found.count("\n") == 6 and found.startswith("Head\n") and "link" not in found and "short" not in found


def test_broken_and_odd_pages():
    assert main_text(None) == main_text("") == main_text("<html>") == main_text("   ") == ""
    assert main_text("no markup &eacute;") == "no markup é"
    assert main_text("<body><nav>only</nav></body>") == ""
    assert main_text("<article><h1>Cut</h1><p>off in a t<b") == "Cut\noff in a t"
    assert main_text("<article><p>one<p>two</div></p></i>three</article>") == "one\ntwo\nthree"
    assert main_text("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>") == "a\nb\nc\nd"
    assert main_text("<article><p>1 < 2 & 3 > 2</p></article>") == "1 < 2 & 3 > 2"
    deep = "<div>" * 5000 + "<p>deep text</p>"
    assert main_text(deep) == "deep text"
    assert main_text("<article><p>" + "word " * 200000) == "word " * 199999 + "word"


def test_extract(spark):
    rows = [(1, "u", PAGE.replace("{}", ARTICLE), "x"), (2, None, None, "y"), (2, None, None, "y"), (None, "v", "<p>t", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted(map(tuple, htmltext.extract(pages).collect()), key=str)
    assert found == sorted([(1, "u", TEXT), (2, None, ""), (2, None, ""), (None, "v", "t")], key=str)
    assert htmltext.extract(pages.limit(0)).collect() == []


PROSE = "".join(f"<p>{'Some words of a paragraph ' * 4}{i}.</p>" for i in range(6))
PLAIN = "\n".join(f"{'Some words of a paragraph ' * 4}{i}." for i in range(6))


@pytest.mark.parametrize("name", ["with-sidebar", "content no-ads", "has-comments banner-page", "related-work"])
def test_names_of_what_holds_the_text(name):
    ads = "<div class='ad'>Buy this</div><div class='user-feedback'><p>A reader says so.</p></div>"
    assert main_text(f"<body><div class='{name}'><main><h1>Head</h1>{PROSE}</main>{ads}</div></body>") == f"Head\n{PLAIN}"
    assert main_text(f"<body><div class='{name}'><h1>Head</h1><div>{PROSE}</div>{ads}</div></body>") == f"Head\n{PLAIN}"
    if name != "has-comments banner-page":
        assert main_text(f"<body><div class='{name}'>{PROSE}</div></body>") == PLAIN


def test_names_against_measures():
    links = "<ul><li><a href=/1>One more article</a></li><li><a href=/2>And another one</a></li></ul>"
    section = "<section class='related-work'><h2>Related work</h2><p>Others have done this before us.</p></section>"
    found = main_text(f"<article>{PROSE}{section}<div class='related'>{links}</div></article>")
    assert found == f"{PLAIN}\nRelated work\nOthers have done this before us."
    # Without telling names: a group of links in an article, and one beside it.
    assert main_text(f"<article>{PROSE}<div>{links}</div><p>Short.</p></article>") == f"{PLAIN}\nShort."
    assert main_text(f"<div>{links * 9}</div><div>{PROSE}</div>") == PLAIN
    # Readers may write more than the author.
    readers = f"<div id='comments'>{PROSE * 8}</div>"
    assert main_text(f"<article><h1>Head</h1>{PROSE}</article>{readers}") == f"Head\n{PLAIN}"


def densities(node, body):
    """(chars, tags, link chars, links) and the density by its formula."""
    sums = [0, 0, 0, 0]
    for x in node.items:
        if isinstance(x, str):
            sums[0] += sum(not c.isspace() for c in x)
            continue
        own = densities(x, body)[0]
        sums[0] += own[0]
        sums[1] += own[1] + 1
        sums[2] += own[0] if x.tag == "a" else own[2]
        sums[3] += own[3] + (x.tag == "a")
    c, t, lc, lt = sums
    if not c or body is None:
        return sums, 0.0
    base = math.log(c / max(1, c - lc) * lc + body[2] / max(1, body[0]) * c + math.e)
    return sums, c / max(1, t) * math.log(max(1, c / max(1, lc) * max(1, t) / max(1, lt))) / math.log(base)


@pytest.mark.parametrize("seed", range(20))
def test_densities_against_their_formula(seed):
    rng = random.Random(seed)

    def tree(depth):
        parts = [f"<a href=x>{'l' * rng.randint(1, 9)}</a>"]
        for _ in range(rng.randint(0, 4)):
            inner = "t " * rng.randint(0, 30) + (tree(depth - 1) if depth and rng.random() < 0.7 else "")
            parts.append(f"<div>{inner}</div>")
        return "".join(parts)

    root = htmltext.parse(tree(3))
    nodes = htmltext._ordered(root)
    htmltext._measure(nodes)
    body = densities(root, None)[0]
    for node in nodes:
        assert node.density == pytest.approx(densities(node, body)[1])
        assert node.sum == pytest.approx(sum(x.density for x in node.children() if x.tag == "div"))
