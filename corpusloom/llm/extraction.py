"""Main text of HTML pages as the maximum-scoring run of words and tags.

A page is read as a sequence of words and tags. Words score by the elements that they stand
in, tags score below zero, and one linear scan finds the contiguous run with the largest
sum: the content region. The scores are logarithms of odds learned from labelled pages:
pages whose publisher marked the content with one ``<article>`` or ``<main>`` (a sample of
the table, bounded by ``FIT_PAGES``), and a few pages labelled by hand for parts that such
a sample may lack. Words of the region that stand in an element which scores below zero (an
advert inside the article) cost little, so that they do not cut the region in two, and are
left out of the text.

Character references are decoded; white space inside a block becomes one space; blocks are
trimmed and joined in page order by one space.

Defined results: a null or empty page, and one without a positive word, gives the empty
text; an unclosed comment, script or style runs to the end of the page; equal sums go to the
earliest and shortest run; repeated rows repeat their result; other columns are kept
whatever their names.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow import add_columns, column, free_name

#: Self-labelled pages that weights are learned from, chosen by a hash of the page.
FIT_PAGES = 2_000
LIMIT = 6.0  # of a weight, either way
ASIDE = 4.0  # most that one run of words in a negative element costs
INSIDE = 0.02  # share of these costs inside a landmark or a positive element
PLAIN = 1.0  # score of a word in no element with a weight

# HTML elements by their role in the standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = ("script", "style", "textarea", "noscript", "template", "iframe", "svg", "title", "select", "button", "object", "math")
LANDMARKS = frozenset(("article", "main"))
PART = frozenset("header footer nav aside section form figure figcaption details dialog address fieldset menu".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    rf"|<({'|'.join(RAW)})(?=[\s/>])[^>]*?(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|[^<]+|<",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\bhidden\b|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_PARTS = re.compile(r"[a-z]+")


@dataclass
class Token:
    """A tag (``words`` 0) or a run of text, and what it stands in."""

    tag: str
    words: int
    text: str
    inside: frozenset[str]


def _features(tag: str, attributes: str, within: bool) -> frozenset[str]:
    names = set()
    if tag in LANDMARKS or tag in PART:
        names.add(f"{tag} within" if within and tag not in LANDMARKS else tag)
    if attributes:
        for found in _NAMES.finditer(attributes):
            names.update("." + w for w in _PARTS.findall((found[1] or found[2] or found[3] or "").lower()))
        if _HIDDEN.search(attributes):
            names.add("hidden")
    return frozenset(names)


def tokens(page: str) -> list[Token]:
    """Words and tags in order; text of raw elements and comments is no word.

    ``inside`` has the landmark, the parts and the class names that the token stands in;
    what is outside the outermost landmark counts only if it is a part (a page's class
    names say little about its article). Text outside the landmarks of a page that has one
    stands in ``outside``.
    """
    out: list[Token] = []
    stack: list[tuple[str, frozenset[str], frozenset[str]]] = []  # tag, own and inherited features
    landmark = False
    seen_landmark = False
    nothing: frozenset[str] = frozenset()
    for found in _TOKEN.finditer(page):
        whole = found[0]
        if found[3]:
            tag = found[3].lower()
            if found[2]:
                if any(open_tag == tag for open_tag, _, _ in stack):
                    while stack.pop()[0] != tag:
                        pass
                    landmark = any(t in LANDMARKS for t, _, _ in stack)
                out.append(Token(tag, 0, "", stack[-1][2] if stack else nothing))
                continue
            if tag in CLOSES_P:
                _close(stack, "p")
            elif tag in ("li", "td", "th", "tr", "dt", "dd", "option"):
                _close(stack, tag)
            above = stack[-1][2] if stack else nothing
            out.append(Token(tag, 0, "", above))
            if tag in VOID or found[4].rstrip().endswith("/"):
                continue
            own = _features(tag, found[4], landmark) if tag not in ("html", "body") else nothing
            if tag in LANDMARKS and not landmark:
                above = frozenset(n for n in above if n[0] != ".")
                landmark = seen_landmark = True
            stack.append((tag, own, above | own))
        elif found[1]:
            out.append(Token(found[1].lower(), 0, "", stack[-1][2] if stack else nothing))
        elif whole[0] != "<" or len(whole) == 1:
            text = html.unescape(whole)
            out.append(Token("", len(text.split()), text, stack[-1][2] if stack else nothing))
    if seen_landmark:
        for token in out:
            if not token.inside & LANDMARKS:
                token.inside |= {"outside"}
    return out


def _close(stack: list, tag: str) -> None:
    """Close an open ``tag`` that no part or block stands in the way of."""
    for depth in range(len(stack) - 1, -1, -1):
        if stack[depth][0] == tag:
            del stack[depth:]
            return
        if stack[depth][0] not in INLINE:
            return


@dataclass
class Weights:
    """Logarithms of odds: of what words stand in, and of tags."""

    places: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)

    def place(self, inside: frozenset[str]) -> float:
        """The lowest weight if one is below zero, else the highest."""
        known = [self.places[n] for n in inside if n in self.places]
        if not known:
            return PLAIN
        low = min(known)
        return low if low < 0 else max(known)

    def extract(self, page: str | None) -> str:
        if not page:
            return ""
        sequence = tokens(page)
        scores = []
        for token in sequence:
            place = self.place(token.inside)
            if place > 0 and not token.tag:
                scores.append(token.words * place)
                continue
            cost = self.tags.get(token.tag, -1.0) if token.tag else max(-ASIDE, token.words * place)
            scores.append(cost * INSIDE if place > 0 or token.inside & LANDMARKS else cost)
        begin, end = best_run(scores)
        blocks: list[list[str]] = [[]]
        for token in sequence[begin:end]:
            if token.tag:
                if token.tag not in INLINE:
                    blocks.append([])
            elif self.place(token.inside) > 0:
                blocks[-1].append(token.text)
        joined = (" ".join("".join(block).split()) for block in blocks)
        return " ".join(block for block in joined if block)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous run with the largest sum; an empty run if none is positive."""
    best, begin, end = 0.0, 0, 0
    total, start = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, begin, end = total, start, i + 1
    return begin, end


#: Labelled by hand: content stands between the brackets.
LABELLED = (
    "<body><header class='site-header'><div class='logo'>Site</div></header><div class='menu'>Home News</div><main><header><h1>⟦Title of it⟧</h1></header><div class='content'><p>⟦Body text.⟧</p><aside class='related'>More stories</aside><p>⟦More body.⟧</p></div><footer>Tags and shares</footer></main><footer>Imprint</footer></body>",
    "<body><div class='navbar nav'>Home</div><div class='post entry'><h1>⟦Title⟧</h1><div class='entry-content'>⟦Body text⟧</div></div><div class='sidebar widget'>Recent posts</div><div id='comments' class='comment-list'><p class='comment'>I agree</p></div><div class='footer'>Contact</div></body>",
    "<body><div class='cookie-notice banner consent'>We use cookies</div><div class='breadcrumb breadcrumbs'>Home</div><div id='content' class='article-body story'><p>⟦Body⟧</p></div><div class='advert ads ad advertisement sponsored promo promotion'>Buy now</div><form class='newsletter subscribe signup'>Your mail</form></body>",
    "<body><article><h1>⟦Title⟧</h1><section><p>⟦Body⟧</p></section><section class='comments'><article class='comment reply'><p>A reader says</p></article></section><aside>Read also</aside><form>Reply here</form><nav>Next page</nav><div class='share social sharing'>Share</div><div class='notice alert warning popup modal overlay'>Notice</div></article></body>",
    "<body><nav>Menu</nav><aside class='sidebar'>Links</aside><div class='text body'><p>⟦Body⟧</p><figure><figcaption>⟦Caption⟧</figcaption></figure><div hidden class='hidden'>Not shown</div></div><div class='related recommended teaser'>Other stories</div><div class='login search pagination pager'>Search</div><footer>Copyright</footer></body>",
    "<body><div class='header masthead topbar toolbar'>Name</div><main id='main'><section class='article'><h2>⟦Part⟧</h2><p>⟦Body⟧</p></section><section id='disqus responses replies discussion feedback'>Comments by readers</section></main><menu>File</menu><dialog>Sign in</dialog><div class='copyright legal disclaimer'>Rights</div></body>",
)


def _count(sequence: list[Token], content: list[bool]) -> Counter:
    """Pages' counts: (feature, is content) once per page, and tags by the words next to them."""
    found: Counter = Counter()
    for token, good in zip(sequence, content, strict=True):
        if token.tag:
            found["<" + token.tag, good] += 1
        elif token.words:
            for name in token.inside:
                found[name, good] = 1
    return found


def _hand_counts() -> Counter:
    total: Counter = Counter()
    for page in LABELLED:
        sequence = tokens(page)
        total.update(_count(sequence, [("⟦" in t.text) if not t.tag else False for t in sequence]))
    return total


def _self_counts(page: str) -> Counter:
    """Of a page that marks its content: words in the landmark are content, others are not."""
    sequence = tokens(page)
    return _count(sequence, ["outside" not in t.inside for t in sequence])


def learn(pages: DataFrame, page: str = "html", fit_pages: int = FIT_PAGES) -> Weights:
    """Weights from the pages labelled by hand and at most about ``fit_pages`` self-labelled ones."""
    text = F.col(page)
    marked = pages.select(text.alias("page")).filter(
        (F.regexp_count(text, F.lit("(?i)<article[\\s>]")) + F.regexp_count(text, F.lit("(?i)<main[\\s>]"))) == 1
    )
    n = pages.count()
    chosen = marked.filter((F.pmod(F.xxhash64("page"), F.lit(1_000_000)) / 1e6) < min(1.0, fit_pages / max(n, 1)))

    def count(batches):
        for batch in batches:
            total: Counter = Counter()
            for text in column(batch, "page").to_pylist():
                total.update(_self_counts(text))
            keys = list(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()), pa.array([total[k] for k in keys], pa.int64())],
                ["name", "good", "n"],
            )

    # A sample of FIT_PAGES pages: what is collected is bounded by their class names.
    counted = chosen.mapInArrow(count, "name string, good boolean, n bigint").groupBy("name", "good").agg(F.sum("n").alias("n"))
    total = _hand_counts()
    for row in counted.filter("n >= 2").collect():
        total[row["name"], row["good"]] += row["n"]
    return _weights(total)


def _weights(total: Counter) -> Weights:
    out = Weights()
    for name in sorted({name for name, _ in total}):
        good, bad = total[name, True], total[name, False]
        odds = max(-LIMIT, min(LIMIT, math.log((good + 0.5) / (bad + 0.5))))
        if name[0] == "<":
            out.tags[name[1:]] = min(-0.1, odds)
        elif abs(odds) > 0.5:
            out.places[name] = odds
    return out


def with_main_text(pages: DataFrame, weights: Weights, page: str = "html", drop: tuple[str, ...] = (), name: str = "text") -> DataFrame:
    """``pages`` and their main text; rows are only mapped over."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def work(batch):
        learned = shared.value
        return [pa.array([learned.extract(p) for p in column(batch, page).to_pylist()], pa.string())]

    return add_columns(pages, [T.StructField(free_name(pages, name), T.StringType())], work, drop)
