"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks, each with its ancestor tags, the meaning of its ancestors' names, and text features. The
field gives every block a state, article or not, with weights for features and for neighbouring states; it is trained by
stochastic gradients on labelled pages and decoded by Viterbi. Labelled pages are a bounded sample of the given pages
whose containers say what they hold, and built-in layouts; each is also seen with its structure hidden.

A null or empty page, one without text and one without article blocks gives an empty text. Every row gives one row, also
rows that repeat an id or have none. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodestrata.llm import sampling, text as T

#: Pages that weights are fitted on, about, drawn by hash; passes over them.
LABELLED, PASSES = 150, 12

# Elements of the markup language by role.
RAW = frozenset("script style noscript template textarea select option title iframe object svg canvas audio video head button".split())
#: What a formula holds beside what it shows.
NOTES = frozenset("annotation annotation-xml".split())
#: Of these, elements that hold no markup, and those that hold the rest of the page where they have no end tag.
PLAIN = frozenset("script style iframe textarea title".split())
TO_END = frozenset("script style iframe textarea".split())
#: Start tags that end an element without an end tag: an option, the head, a drawing (save in its own HTML parts).
ENDED_BY = {
    "option": frozenset("option optgroup select datalist".split()), "head": frozenset(("body",)),
    "svg": frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
                     "ol p pre ruby s small span strong strike sub sup table tt u ul var".split())}
HTML_IN_SVG = frozenset("foreignobject desc title".split())
#: A paragraph outside of these does not end where a block inside them starts.
HOLDS_P = RAW | frozenset("td th article div section body".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr "
                   "math maction menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace "
                   "msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics none".split())
# Elements and words in class, id and role that tell what a container holds.
OTHER_TAGS = frozenset("nav aside footer header form menu dialog fieldset".split())
MAIN_TAGS = frozenset("article main".split())
OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement alert author-box banner breadcrumb breadcrumbs byline comment comments commentlist consent "
    "cookie cookies copyright disqus discussion dialog footer form gdpr header login masthead menu meta modal nav navbar navigation "
    "newsletter notice notices notification pager pagination popup promo promoted recommended related replies reply respond search share "
    "sharing sidebar signup site-footer site-header social sponsor sponsored subscribe tags teaser toolbar tracking widget widgets".split())
MAIN_WORDS = frozenset("article article-body articlebody body-text content entry entry-content main main-content maintext post "
                       "post-body post-content story story-body text".split())

MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+|[^>]*)>""", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, str], ...]
    linked: int = 0


def meaning(tag: str, attributes: str) -> str:
    """What a container says it holds: 'main', 'other' or nothing."""
    names = {w for m in NAMES.finditer(attributes) for w in re.split(r"[\s_]+", (m[1] or m[2] or m[3] or "").lower())}
    parts = names | {p for w in names for p in w.split("-")}
    if tag in OTHER_TAGS or parts & OTHER_WORDS:
        return "other"
    return "main" if tag in MAIN_TAGS or parts & MAIN_WORDS else ""


def plain_end(page: str, at: int, tag: str) -> int | None:
    """Where the text of an element without markup is over, its end tag included."""
    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
    return end.end() if end else None


def element_ends(page: str) -> dict[int, tuple[int, bool]]:
    """Where elements with markup inside are over, by where their start tag is over, and whether by their own end tag.

    One pass with one stack, so that time goes with the length however many elements stay open. Without an end tag of its
    own an element ends before the end tag of an element around it, or before a start tag that ends it; what the page does
    not tell is left out.
    """
    ends: dict[int, tuple[int, bool]] = {}
    open_: list[tuple[str, int]] = []
    depth: Counter[str] = Counter()
    endless: set[str] = set()
    at = 0

    def pop(before: int) -> str:
        name, start = open_.pop()
        depth[name] -= 1
        ends[start] = (before, False)
        return name

    while m := MARKUP.search(page, at):
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if depth[name]:
                while open_[-1][0] != name:
                    pop(m.start())
                ends[open_[-1][1]] = (at, True)
                depth[open_.pop()[0]] -= 1
            continue
        for tag, enders in ENDED_BY.items():
            if name in enders and depth[tag] and not (tag == "svg" and any(depth[t] for t in HTML_IN_SVG)):
                while pop(m.start()) != tag:
                    pass
        if name not in INLINE and name not in RAW and depth["p"]:  # a paragraph that this block ends
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] in HOLDS_P:
                    break
                if open_[i][0] == "p":
                    while len(open_) > i:
                        pop(m.start())
                    break
        if name in VOID or m[3].rstrip().endswith("/"):
            continue
        if name in PLAIN and not (name == "title" and depth["svg"]):
            end = None if name in endless else plain_end(page, at, name)
            if end is not None:
                at = end
                continue
            endless.add(name)
            if name in TO_END:
                break
        else:
            open_.append((name, at))
            depth[name] += 1
    return ends


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, white space collapsed and character references decoded; those without text are left out."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked = at = 0
    ends: dict[int, tuple[int, bool]] | None = None

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, tuple(x for x in stack if x[0] not in INLINE or x[1]), min(linked, len(text))))
        parts.clear()
        linked = 0

    def close(tag: str, within: frozenset[str] = frozenset()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return
            if stack[i][0] in within:
                return

    while True:
        m = MARKUP.search(page, at)
        raw = page[at:m.start()] if m else page[at:]
        if raw:
            parts.append(raw)
            if any(t == "a" for t, _ in stack):
                linked += len(raw)
        if m is None:
            flush()
            return out
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW or tag in NOTES and any(t == "math" for t, _ in stack):
            if not closing and not m[3].rstrip().endswith("/"):
                if tag in PLAIN:
                    end = plain_end(page, at, tag)
                    if end is not None or tag in TO_END:
                        at = len(page) if end is None else end
                else:
                    ends = element_ends(page) if ends is None else ends
                    end = ends.get(at)
                    if end and (end[1] or tag not in ("head", "button")):
                        at = end[0]
            if tag not in INLINE:
                parts.append(" ")
            continue
        if tag in INLINE:
            if tag == "mtd" and not closing:
                parts.append(" ")
            if tag in ("br", "wbr", "img"):
                parts.append(" " if tag != "wbr" else "")
            elif closing:
                close(tag, frozenset(t for t, _ in stack) - INLINE - {tag})
            else:
                stack.append((tag, meaning(tag, m[3])))
            continue
        flush()
        if closing:
            close(tag)
        elif tag not in VOID:
            if tag in ("li", "td", "th", "tr", "dt", "dd"):
                close(tag, frozenset(("ul", "ol", "dl", "table", "menu")))
            close("p", frozenset(("td", "th", "article", "div", "section", "body")))
            if not m[3].rstrip().endswith("/"):
                stack.append((tag, meaning(tag, m[3])))


def path_features(path: tuple[tuple[str, str], ...]) -> list[str]:
    said = [m for _, m in path if m]
    return [*{f"tag {t}" for t, _ in path}, *{f"holds {m}" for m in said}, f"inner {said[-1] if said else 'nothing'}",
            f"own {path[-1][0] if path else 'none'}"]


def text_features(block: Block) -> list[str]:
    text = block.text
    dense = 0 if not block.linked else 1 + (4 * block.linked >= len(text)) + (10 * block.linked >= 9 * len(text))
    return ["always", f"chars {min(len(text), 4095).bit_length()}", f"words {min(text.count(' ') + 1, 255).bit_length()}", f"links {dense}",
            f"stop {text[-1] in '.!?…:;'}", f"mark {'©' in text or '|' in text or '»' in text}"]


@dataclass
class Field_:
    """Weights of features for an article block (against any other), and of neighbouring states."""
    weights: dict[str, float] = field(default_factory=dict)
    moves: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])

    def scores(self, page: list[Block], structure: bool = True, known: dict | None = None) -> list[float]:
        known = {} if known is None else known
        out = []
        for b in page:
            path = b.path if structure else ()
            if path not in known:
                known[path] = sum(self.weights.get(f, 0.0) for f in path_features(path))
            out.append(known[path] + sum(self.weights.get(f, 0.0) for f in text_features(b)))
        return out

    def decode(self, scores: list[float]) -> list[bool]:
        """The best states by Viterbi; a tie goes to the article."""
        if not scores:
            return []
        best, back = [0.0, scores[0]], []
        for s in scores[1:]:
            step = [[best[a] + self.moves[a][b] for a in (0, 1)] for b in (0, 1)]
            back.append([int(step[b][1] >= step[b][0]) for b in (0, 1)])
            best = [max(step[0]), max(step[1]) + s]
        state = int(best[1] >= best[0])
        out = [bool(state)]
        for choice in reversed(back):
            state = choice[state]
            out.append(bool(state))
        return out[::-1]

    def marginals(self, scores: list[float]) -> tuple[list[float], list[list[float]]]:
        """Chance of the article for every block, and expected counts of neighbouring states, by forward and backward sums."""
        def log_sum(a: float, b: float) -> float:
            return max(a, b) + math.log1p(math.exp(-abs(a - b)))

        n, m = len(scores), self.moves
        ahead = [[0.0, scores[0]]]
        for s in scores[1:]:
            a = ahead[-1]
            ahead.append([log_sum(a[0] + m[0][0], a[1] + m[1][0]), log_sum(a[0] + m[0][1], a[1] + m[1][1]) + s])
        behind = [[0.0, 0.0]]
        for s in reversed(scores[1:]):
            b = behind[-1]
            behind.append([log_sum(m[y][0] + b[0], m[y][1] + s + b[1]) for y in (0, 1)])
        behind.reverse()
        total = log_sum(*ahead[-1])
        chance = [math.exp(min(0.0, ahead[i][1] + behind[i][1] - total)) for i in range(n)]
        moved = [[0.0, 0.0], [0.0, 0.0]]
        for i in range(1, n):
            for x in (0, 1):
                for y in (0, 1):
                    moved[x][y] += math.exp(min(0.0, ahead[i - 1][x] + m[x][y] + y * scores[i] + behind[i][y] - total))
        return chance, moved


def train(pages: list[tuple[list[Block], list[bool]]], passes: int = PASSES, seed: int = 0, rate: float = 0.5) -> Field_:
    """Adaptive stochastic gradients of the log likelihood, one page with and one without structure at a time."""
    model, squares, draw = Field_(), defaultdict(lambda: 1e-6), random.Random(seed)
    pages = [p for p in pages if p[0]]
    for _ in range(passes):
        draw.shuffle(pages)
        for page, truth in pages:
            for structure in (True, True, True, False):
                chance, moved = model.marginals(model.scores(page, structure))
                slope: dict[str, float] = defaultdict(float)
                for b, p, y in zip(page, chance, truth, strict=True):
                    for f in path_features(b.path if structure else ()) + text_features(b):
                        slope[f] += y - p
                for f, g in slope.items():
                    g -= 1e-3 * model.weights.get(f, 0.0)
                    squares[f] += g * g
                    model.weights[f] = model.weights.get(f, 0.0) + rate * g / math.sqrt(squares[f])
                for x, y in zip(truth[:-1], truth[1:], strict=True):
                    moved[x][y] -= 1
                for x in (0, 1):
                    for y in (0, 1):
                        squares[f"{x}{y}"] += moved[x][y] ** 2
                        model.moves[x][y] -= rate * moved[x][y] / math.sqrt(squares[f"{x}{y}"])
    return model


def labels_of(page: list[Block]) -> list[bool] | None:
    """Article or not as the innermost telling container says; nothing if no container of the page claims the article."""
    said = [next((m for _, m in reversed(b.path) if m), "") for b in page]
    return [s == "main" for s in said] if "main" in said else None


def layouts(seed: int = 0) -> list[tuple[list[Block], list[bool]]]:
    """Labelled pages in layouts of several kinds, filled with made-up words."""
    draw = random.Random(seed)

    def words(low: int, high: int) -> str:
        return " ".join("".join(draw.choice("aeioubcdlmnrst") for _ in range(draw.randint(2, 9))) for _ in range(draw.randint(low, high)))

    def links(n: int) -> str:
        return "<ul>" + "".join(f"<li><a href='/{i}'>{words(1, 3)}</a></li>" for i in range(n)) + "</ul>"

    out = []
    for _ in range(60):
        foreign = lambda: draw.choice((
            f"<div class='{draw.choice(('ad', 'sponsored', 'share', 'promo', 'newsletter', 'cookie-notice', 'alert'))}'>{words(2, 30)}.</div>",
            f"<aside><p>{words(3, 40)}.</p></aside>", f"<form><p>{words(2, 20)}</p></form>", f"<div class='related'>{links(3)}</div>",
            f"<div class='comments'><p>{words(5, 60)}.</p><p>{words(2, 40)}.</p></div>"))
        paragraphs = "".join(
            (f"<x-other>{foreign()}</x-other>" if draw.random() < 0.2 else "")
            + f"<p>{words(*draw.choice(((1, 3), (8, 60), (20, 120))))}.</p>" for _ in range(draw.randint(1, 9)))
        title = f"<h1>{words(3, 8)}</h1>"
        holder = draw.choice(("article", "main", "div class='post'", "div id='content'", "div class='entry-content'",
                              "section class='story-body'", "div", "div class='c12'", "section"))
        body = [f"<header><div class='logo'>{words(1, 3)}</div></header>", f"<nav>{links(draw.randint(3, 8))}</nav>",
                foreign(), f"<{holder}><x-main>{title}{paragraphs}</x-main></{holder.split()[0]}>",
                f"<aside>{links(4)}<p>{words(5, 20)}.</p></aside>", foreign(), foreign(),
                f"<footer>© {words(2, 12)}. {words(2, 9)}.</footer>"]
        inside = [b for i, b in enumerate(body) if i in (0, 1, 3, 7) or draw.random() < 0.5]
        page = blocks("<body>" + "".join(inside) + "</body>")
        hidden = [[t for t, _ in b.path if t.startswith("x-")] for b in page]
        out.append(([Block(b.text, tuple(x for x in b.path if not x[0].startswith("x-")), b.linked) for b in page],
                    [h == ["x-main"] for h in hidden]))
    return out


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", labelled: int = LABELLED) -> Field_:
    """The field trained on the built-in layouts and on a bounded sample of the pages."""
    sample = sampling.about(pages.where(F.col(html_col).isNotNull()).select(id_col, html_col), labelled, id_col, html_col) \
        .orderBy(id_col, html_col).select(html_col).collect()  # about LABELLED rows
    known = [(page, truth) for page in (blocks(r[0]) for r in sample) if (truth := labels_of(page)) is not None]
    return train(layouts() + known)


def article(page: str, model: Field_, known: dict | None = None) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, y in zip(found, model.decode(model.scores(found, known=known)), strict=True) if y)


def _extract(model: Field_):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            for part in T.slices(batch, "html", 4 << 20):
                texts = []
                for page in part.column("html").to_pylist():
                    if len(known) > 50_000:
                        known.clear()
                    texts.append(article(page, model, known) if page else "")
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, model: Field_ | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    model = model or fit(pages, id_col, html_col)
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html")) \
        .mapInArrow(_extract(model), "page_id long, url string, text string, n_chars long")
