"""Main-text extraction from web pages.

The page is cut into flat text blocks at block-level tags.  Every block has
its word count and link density, those of its two neighbours, and the kind of
its nearest telling container (article; or menu, header, footer, sidebar,
notice, advert, form, comments).  A decision tree, trained here on a small
labelled table of such blocks, keeps or drops each block: what is in a
surrounding container goes; in an article, lists of links go; outside both,
size, link density and the neighbours decide.

A container is told by its element or role, or by a word of its class or id
(``site-footer``, but not ``has-sidebar`` or ``no-comments``).  A form, field
set or dialog that holds most words of the page is a wrapper and tells nothing.

Scripts, styles, comments and other raw elements are skipped, character
references decoded, white space inside a block becomes one space, and blocks
are joined by an empty line in page order.  Unclosed elements, quotes and
tags are tolerated.  A null or empty page gives an empty text; repeated rows
give repeated results; a page is read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import table

# fixed values: element names
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody
td tfoot th thead title tr ul""".split())
HOLDERS = frozenset("""article aside body center details dialog div dl fieldset figure footer form head header li main menu nav ol
section span table td tr ul""".split())
RAW = frozenset("script style noscript template svg math iframe object canvas textarea select button title audio video".split())
ARTICLE = frozenset(("article", "main"))
AROUND = frozenset(("head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"))
AROUND_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
AROUND_WORDS = frozenset("""ad ads adbox adslot advert advertisement advertising banner breadcrumb breadcrumbs byline comment comments
commentlist consent cookie cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter
notice notification pager pagination popup privacy promo promoted recommend recommended recommendations related replies reply respond
search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget""".split())
WRAPPERS = frozenset(("form", "fieldset", "dialog"))  # tell nothing where they hold most words of a page
NEGATIONS = frozenset("no not non without with has have hide is".split())  # a class name with one says what else there is

FEATURES = ("holder", "words", "links", "words_before", "links_before", "words_after", "links_after")
# fixed values: the labelled table.  holder: 1 article, -1 around it, 0 neither; links: share of words in links; last: 1 main text
LABELLED = """
 1  40 0.00  35 0.00  52 0.00 1
 1   1 0.00  30 0.00  41 0.00 1
 1   2 0.00   1 0.00   1 0.00 1
 1   8 0.00   0 0.00  60 0.00 1
 1  90 0.05  70 0.10  20 0.00 1
 1   6 1.00  40 0.00  33 0.00 1
 1  25 0.40  10 0.00   4 1.00 1
 1   3 0.00   4 1.00   0 0.00 1
 1 300 0.00   5 1.00   8 1.00 1
 1  12 0.00   9 0.00   6 0.00 1
 1   7 1.00  55 0.00   0 0.00 1
 1   4 1.00   0 0.00  60 0.00 1
 1   5 0.80  30 0.10  42 0.00 1
 1   4 1.00  60 0.00   3 1.00 0
 1   3 1.00   4 1.00   5 1.00 0
 1   5 1.00   3 1.00   4 1.00 0
 1   6 1.00   5 1.00  40 0.00 0
 1   8 0.90   6 1.00   7 1.00 0
 1   3 1.00   4 1.00   0 0.00 0
 1   9 1.00   7 0.90  50 0.05 0
 1   4 1.00  15 0.00   3 1.00 0
 1   3 1.00  30 0.00   5 1.00 0
 1   8 0.00  20 0.00   5 0.00 1
 1  30 0.00  25 0.00   2 1.00 1
 1  20 0.10   4 1.00   0 0.00 1
 1   6 1.00  70 0.00  40 0.00 1
-1   4 1.00   3 1.00   5 1.00 0
-1   9 0.00  40 0.00   0 0.00 0
-1  60 0.00   1 1.00  45 0.00 0
-1 120 0.02  20 0.00  30 0.00 0
-1   1 0.00   1 0.00   1 0.00 0
-1  15 0.00   4 1.00   8 0.00 0
-1  35 0.10  80 0.00   2 0.00 0
-1   2 1.00  50 0.00  50 0.00 0
-1 200 0.00 200 0.00 200 0.00 0
-1   7 0.00   6 0.00  33 0.00 0
 0  45 0.00  50 0.00  38 0.00 1
 0  30 0.05  25 0.00  60 0.10 1
 0  18 0.00  40 0.00  22 0.00 1
 0  80 0.20   6 0.00  55 0.00 1
 0  25 0.00   3 1.00  70 0.00 1
 0  60 0.00  45 0.05   2 1.00 1
 0   8 0.00   2 1.00  55 0.00 1
 0   6 0.00  48 0.00  52 0.00 1
 0   9 0.00  60 0.00  12 0.00 1
 0 150 0.10   0 0.00   0 0.00 1
 0  35 0.25  20 0.00  44 0.00 1
 0   4 0.00  33 0.00  29 0.00 1
 0   5 0.00  60 0.00  50 0.00 1
 0   2 0.00  22 0.00  20 0.00 1
 0   4 0.00   2 1.00  12 0.00 1
 0   6 0.00   3 1.00  16 0.00 1
 0   3 0.00   0 0.00  14 0.00 1
 0  21 0.00  20 0.00   1 1.00 1
 0  30 0.00  12 0.00   2 1.00 1
 0  24 0.10   2 0.00   0 0.00 1
 0  40 0.00  30 0.00   3 0.00 1
 0  55 0.00   4 1.00   0 0.00 1
 0   3 0.00  45 0.00  30 0.00 1
 0   7 0.00   3 1.00  60 0.00 1
 0   5 0.00   2 1.00  40 0.00 1
 0  14 0.00  40 0.00   0 0.00 1
 0  16 0.00  25 0.00   4 1.00 1
 0  10 0.00  60 0.00  45 0.00 1
 0   9 0.00   3 1.00   4 1.00 0
 0  10 0.00   0 0.00   2 1.00 0
 0  12 0.00   5 1.00   0 0.00 0
 0   8 0.00   3 1.00   0 0.00 0
 0  11 0.00   2 1.00   3 1.00 0
 0   3 1.00   2 1.00   4 1.00 0
 0   5 0.90  40 0.00   3 1.00 0
 0   2 1.00   0 0.00   2 1.00 0
 0  20 0.80   5 1.00   6 1.00 0
 0  40 0.70   3 1.00   9 0.60 0
 0   4 0.00   3 1.00   2 1.00 0
 0   6 0.00   4 0.80   0 0.00 0
 0   3 0.00   2 0.00   4 0.00 0
 0   5 0.00   1 0.00   3 1.00 0
 0   7 0.00   3 0.00   0 0.00 0
 0  12 0.60  60 0.00   4 1.00 0
 0   1 1.00   1 1.00  40 0.00 0
 0   2 1.00   3 1.00  60 0.00 0
 0   4 0.90   0 0.00  25 0.00 0
 0   5 1.00  50 0.00  30 0.00 0
 0  30 0.80  20 0.00  40 0.00 0
 0   2 0.00   5 1.00   1 0.00 0
"""


def labelled_rows() -> list[tuple[tuple[float, ...], int]]:
    rows = [[float(x) for x in line.split()] for line in LABELLED.strip().splitlines()]
    return [(tuple(r[:-1]), int(r[-1])) for r in rows]


def grow(rows, depth: int = 6):
    """CART by Gini impurity: a leaf is its label, a node (feature, threshold, below, above)."""
    ones = sum(y for _, y in rows)
    label = int(2 * ones >= len(rows))
    if not depth or ones in (0, len(rows)):
        return label
    best = None
    for f in range(len(rows[0][0])):
        values = sorted({x[f] for x, _ in rows})
        for low, high in zip(values, values[1:], strict=False):
            cut = (low + high) / 2
            sides = [[y for x, y in rows if (x[f] <= cut) == side] for side in (True, False)]
            impurity = sum(2 * sum(s) * (len(s) - sum(s)) / len(s) for s in sides)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, cut)
    if best is None:
        return label
    _, f, cut = best
    return (f, cut, grow([r for r in rows if r[0][f] <= cut], depth - 1), grow([r for r in rows if r[0][f] > cut], depth - 1))


def decide(tree, x) -> int:
    while not isinstance(tree, int):
        f, cut, below, above = tree
        tree = below if x[f] <= cut else above
    return tree


def blocks(page: str) -> list[tuple[str, int, float, int]]:
    """(text, words, link density, holder) of every block with text, in page order."""
    import html
    import re

    tag = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][\w:.-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][\w:.-]*)([^>]*)(?:>|\Z)""",
                     re.S)
    named = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
    split = re.compile(r"[^a-z]+")

    def around(value: str) -> bool:
        for token in value.split():
            words = [w for w in split.split(token) if w]
            if NEGATIONS.isdisjoint(words) and not AROUND_WORDS.isdisjoint(words):
                return True
        return False

    def mark(name: str, attributes: str) -> tuple[int, bool]:
        """What an element says about the blocks in it (0: nothing), and whether it may be a wrapper."""
        if attributes:
            for m in named.finditer(attributes):
                value = (m[2] or m[3] or m[4] or "").lower()
                if m[1].lower() == "role":
                    if value.strip() in AROUND_ROLES:
                        return -1, False
                    if value.strip() in ARTICLE:
                        return 1, False
                elif name not in ("body", "html") and around(value):
                    return -1, False
        return (1, False) if name in ARTICLE else (-1, name in WRAPPERS) if name in AROUND else (0, False)

    found, parts, stack = [], [], []   # parts: (text, in a link)
    containers = []                    # [mark, may be a wrapper, words, the container around it]
    link, inner = 0, -1                # inner: the nearest container
    at = 0

    def flush():
        if parts:
            text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
            if text:
                words = len(text.split(" "))
                inside = len(html.unescape("".join(p if k else " " for p, k in parts)).split()) if any(k for _, k in parts) else 0
                found.append((text, words, min(1.0, inside / words), inner))
                if inner >= 0:
                    containers[inner][2] += words
            parts.clear()

    size = len(page)
    while at < size:
        m = tag.search(page, at)
        if not m:
            parts.append((page[at:], link))
            break
        if m.start() > at:
            parts.append((page[at:m.start()], link))
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing = bool(m[1] or m[4])
        attributes = m[3] if m[2] else m[6]
        if name in RAW and not closing:
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else size
            if name in BLOCKS:
                flush()
            continue
        if name == "br":
            parts.append((" ", link))
            continue
        if name == "a":
            link = 0 if closing else 1
            continue
        if name in BLOCKS:
            flush()
            link = 0
        if name in HOLDERS:
            if closing:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        flush()
                        del stack[i:]
                        break
            elif not attributes.rstrip().endswith("/"):
                said, wraps = mark(name, attributes)
                if said:
                    flush()
                if name == "body":
                    stack = [x for x in stack if x[0] != "head"]
                outer = stack[-1][1] if stack else -1
                if said:
                    containers.append([said, wraps, 0, outer])
                    outer = len(containers) - 1
                stack.append((name, outer))
            inner = stack[-1][1] if stack else -1
    flush()
    # containers come after those around them: sums from the last one on, marks from the first
    total = sum(b[1] for b in found)
    for c in reversed(containers):
        if c[3] >= 0:
            containers[c[3]][2] += c[2]
    for c in containers:
        if c[1] and 2 * c[2] > total:
            c[0] = containers[c[3]][0] if c[3] >= 0 else 0
    return [(text, words, links, containers[i][0] if i >= 0 else 0) for text, words, links, i in found]


def main_text(page: str | None, tree) -> str:
    """The main text of one page."""
    found = blocks(page) if page else []
    none = ("", 0, 0.0, 0)
    kept = []
    for i, (text, words, links, holder) in enumerate(found):
        before, after = found[i - 1] if i else none, found[i + 1] if i + 1 < len(found) else none
        if decide(tree, (holder, words, links, before[1], before[2], after[1], after[2])):
            kept.append(text)
    return "\n\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): one row per row of ``pages``."""
    tree = grow(labelled_rows())

    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = [main_text(h, tree) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.col("html").cast("string").alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op4_html(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
