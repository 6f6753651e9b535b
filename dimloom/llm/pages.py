"""Main text of HTML pages: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks, the runs of text between block-level tags.  Ancestor tags, class families and text features of each block, and
whether it shares its container with the block before, feed a chain of two labels (main text or not), decoded by Viterbi.

Training pages are labelled by construction: the paragraphs of at most ``TRAIN_PAGES`` sampled pages that mark their article by a tag are set
into layouts of many kinds, with and without telling tags and class names, among menus, notices, adverts, sidebars, forms, comments and footers
made from the sampled pages' own other blocks; the sampled pages themselves are added with their marks.

Defined results: null or empty html, and a page without main text, gives an empty text and 0 characters; text in script, style, head, template,
noscript, svg, form controls and comments is never a block; broken markup is read as browsers do for the usual cases (missing end tags,
stray end tags, unclosed raw text); repeated rows and null ids are read row by row; extra columns are ignored; html of any length is read whole.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sampled pages and layouts made of each.
TRAIN_PAGES, LAYOUTS = 120, 5

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|[^<]+|<", re.S)
#: A tag with a quote that is never closed.
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_BEGUN = re.compile(r"</?[a-zA-Z]")
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW = frozenset("script style textarea title noscript template svg iframe select xmp".split())
#: Those whose text browsers read to the end of the page if they are not closed; of the others only the tag is skipped then.
_TO_END = frozenset("script style textarea title iframe xmp".split())
#: What leaves an open head open.
_HEAD = frozenset("head html title meta link base style script template noscript".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
                    "time tt u var wbr img br".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}}
_CONTAINER = frozenset("html body article main section div nav header footer aside form table ul ol dl blockquote figure li td".split())
#: Families of class, id and role names, by parts of words.
FAMILIES = {
    "ad": ("ad", "ads", "advert", "advertisement", "promo", "sponsor", "sponsored", "banner"),
    "menu": ("nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "toc", "pagination", "pager", "tabs"),
    "side": ("side", "sidebar", "aside", "widget", "related", "recommended", "complementary", "rail", "popular", "trending"),
    "foot": ("foot", "footer", "contentinfo", "copyright", "legal"),
    "head": ("head", "header", "masthead", "topbar", "logo"),
    "comment": ("comment", "comments", "reply", "replies", "discussion", "respond", "disqus", "thread"),
    "notice": ("cookie", "cookies", "notice", "consent", "alert", "gdpr", "popup", "modal", "overlay", "banner", "warning", "dialog"),
    "form": ("form", "search", "subscribe", "newsletter", "login", "signup", "share", "social"),
    "main": ("article", "content", "post", "entry", "main", "story", "body", "text", "page"),
}
_FAMILY = {word: family for family, names in FAMILIES.items() for word in names if family != "notice" or word != "banner"}


@dataclass
class Block:
    text: str
    tag: str
    ancestors: frozenset[str]
    families: frozenset[str]
    container: int
    linked: int


def blocks_of(html: str) -> list[Block]:
    # Of each open element: its tag, all open tags, the families of all, its container, and whether a head is among them.
    bottom = ("", frozenset(), frozenset(), 0, False)
    stack: list[tuple[str, frozenset[str], frozenset[str], int, bool]] = []
    depth: Counter[str] = Counter()
    out: list[Block] = []
    parts: list[str] = []
    unclosed: set[str] = set()
    linked, in_link, serial, at, n = 0, False, 0, 0, len(html)

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split()) if parts else ""
        tag, tags, families, box, in_head = stack[-1] if stack else bottom
        if text and not in_head:
            out.append(Block(text, tag, tags, families, box, linked))
        parts.clear()
        linked = 0

    def push(tag: str, named: frozenset[str]) -> None:
        _, tags, families, box, in_head = stack[-1] if stack else bottom
        stack.append((tag, tags if tag in tags else tags | {tag}, families if named <= families else families | named,
                      serial if tag in _CONTAINER and tag not in ("li", "td") else box, in_head or tag == "head"))
        depth[tag] += 1

    def pop() -> str:
        tag = stack.pop()[0]
        depth[tag] -= 1
        return tag

    while at < n:
        m = _TOKEN.match(html, at)
        if m[0] == "<" and _BEGUN.match(html, at):
            m = _LOOSE.match(html, at)
            if m is None:  # an unclosed tag at the end
                break
        at, tag = m.end(), m[2]
        if tag is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                if stack and stack[-1][0] == "head" and not piece.isspace():
                    flush()
                    pop()
                parts.append(piece)
                linked += len(piece) if in_link else 0
            continue
        tag = tag.lower()
        if not m[1] and stack and stack[-1][0] == "head" and tag not in _HEAD:
            flush()
            pop()
        if tag in _RAW:
            if not m[1] and not (tag == "svg" and m[3].endswith("/")) and tag not in unclosed:
                end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
                if end is None:
                    unclosed.add(tag)  # sought once a page
                at = end.end() if end else n if tag in _TO_END else at
            continue
        if tag in _INLINE:
            in_link = not m[1] if tag == "a" else in_link
            if tag in ("br", "img"):
                parts.append(" ")
            continue
        flush()
        in_link = False
        if m[1]:
            while depth[tag] and pop() != tag:
                pass
        elif tag not in _VOID and not m[3].endswith("/"):
            while stack and (stack[-1][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6") or stack[-1][0] in _CLOSES.get(tag, ())):
                pop()
            serial += 1
            named = [w for a in _ATTRIBUTE.finditer(m[3]) for w in re.split(r"[^a-z]+", (a[2] or a[3] or a[4] or "").lower())] if m[3] else []
            push(tag, frozenset(_FAMILY[w] for w in named if w in _FAMILY))
    flush()
    return out


def _size(value: float, steps: tuple[float, ...]) -> int:
    return sum(value >= s for s in steps)


def features(blocks: list[Block]) -> list[list[str]]:
    out = []
    for i, b in enumerate(blocks):
        words = b.text.split()
        ends = b.text[-1]
        names = [f"tag={b.tag}", *{f"in={t}" for t in b.ancestors}, *{f"class={c}" for c in b.families},
                 f"words={_size(len(words), (2, 4, 8, 15, 30, 60))}", f"links={_size(b.linked / max(1, len(b.text)), (0.05, 0.3, 0.7))}",
                 f"ends={'.' if ends in '.!?…。»”\"' else ':' if ends in ':;,' else 'x'}", f"commas={_size(b.text.count(','), (1, 3))}",
                 f"sentences={_size(sum(b.text.count(x) for x in ('. ', '! ', '? ')), (1, 3))}",
                 f"long={_size(sum(len(x.text) > 120 for x in blocks[max(0, i - 2):i + 3]), (1, 2, 4))}",
                 f"digits={_size(sum(c.isdigit() for c in b.text[:400]) / min(400, len(b.text)), (0.05, 0.3))}", "any"]
        if "©" in b.text:
            names.append("sign")
        if "p" in b.ancestors:
            names.append(f"paragraph={min(2, len(words) // 15)}")
        out.append(names)
    return out


class Chain:
    """Weights of block features [feature, 2], and of label pairs, apart for blocks of one container and others [2, 2, 2]."""

    def __init__(self, names: dict[str, int]) -> None:
        self.names = names
        self.emit, self.move = np.zeros((len(names), 2)), np.zeros((2, 2, 2))

    def rows(self, blocks: list[Block]) -> tuple[list[list[int]], np.ndarray]:
        ids = [[self.names[f] for f in own if f in self.names] for own in features(blocks)]
        same = np.array([0] + [int(a.container == b.container) for a, b in zip(blocks, blocks[1:])])
        return ids, same

    def label(self, blocks: list[Block]) -> list[int]:
        """The best labelling, by Viterbi."""
        if not blocks:
            return []
        ids, same = self.rows(blocks)
        score = [self.emit[i].sum(0) for i in ids]
        best, back = score[0], []
        for s, e in zip(same[1:], score[1:]):
            step = best[:, None] + self.move[s]
            back.append(step.argmax(0))
            best = step.max(0) + e
        path = [int(best.argmax())]
        for choice in reversed(back):
            path.append(int(choice[path[-1]]))
        return path[::-1]


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = 120, decay: float = 0.002, rate: float = 0.1) -> Chain:
    """Maximise the conditional likelihood of the labels, by Adam over exact forward-backward gradients of all pages at once."""
    pages = [p for p in pages if p[0]]
    names: dict[str, int] = {}
    for blocks, _ in pages:
        for own in features(blocks):
            for f in own:
                names.setdefault(f, len(names))
    chain = Chain(names)
    if not pages:
        return chain
    longest = max(len(b) for b, _ in pages)
    n = len(pages)
    cells, ids = [], []
    same, gold, mask = np.zeros((n, longest), int), np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for i, (blocks, labels) in enumerate(pages):
        own, joined = chain.rows(blocks)
        same[i, :len(blocks)], gold[i, :len(blocks)], mask[i, :len(blocks)] = joined, labels, True
        for t, row in enumerate(own):
            ids += row
            cells += [i * longest + t] * len(row)
    cells, ids = np.array(cells), np.array(ids)
    aim = np.zeros((n, longest, 2))
    aim[mask, gold[mask]] = 1
    moments = [np.zeros((2, *w.shape)) for w in (chain.emit, chain.move)]
    for r in range(1, rounds + 1):
        emit = np.stack([np.bincount(cells, chain.emit[ids, y], n * longest) for y in (0, 1)], 1).reshape(n, longest, 2)
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = emit[:, 0]
        for t in range(1, longest):
            step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + chain.move[same[:, t]], 1) + emit[:, t]
            ahead[:, t] = np.where(mask[:, t, None], step, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(chain.move[same[:, t + 1]] + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
        total = np.logaddexp.reduce(ahead[:, -1], 1)
        found = np.exp(ahead + behind - total[:, None, None]) * mask[:, :, None]
        off = (found - aim).reshape(-1, 2)
        slope = np.stack([np.bincount(ids, off[cells, y], len(names)) for y in (0, 1)], 1) / n
        pull = np.zeros((2, 2, 2))
        for t in range(1, longest):
            pair = np.exp(ahead[:, t - 1, :, None] + chain.move[same[:, t]] + (emit[:, t] + behind[:, t])[:, None, :] - total[:, None, None])
            pair = (pair - aim[:, t - 1, :, None] * aim[:, t, None, :]) * mask[:, t, None, None]
            np.add.at(pull, same[:, t], pair)
        for w, g, m in zip((chain.emit, chain.move), (slope, pull / n), moments):
            g = g + decay * w
            m[0], m[1] = 0.9 * m[0] + 0.1 * g, 0.99 * m[1] + 0.01 * g * g
            w -= rate * (m[0] / (1 - 0.9 ** r)) / (np.sqrt(m[1] / (1 - 0.99 ** r)) + 1e-8)
    return chain


#: Stand-ins where no sampled page marks its article.
_PLAIN = ["The river rose in the night, and by morning the lower fields were under water. Nobody in the village had seen it so high before.",
          "Most of the houses near the bridge were empty, because their owners had left for the city years ago; only the mill was still at work.",
          "A longer account, with the names of all who helped, was printed in the spring. It was read out in the school, and then forgotten."]
_LABELS = ["Home", "About us", "Contact", "Archive", "News", "Sign in", "Search", "Privacy policy", "Terms of use", "Next page", "Share this"]


def layouts(title: str, paragraphs: list[str], others: list[str], rng: random.Random) -> tuple[str, str]:
    """A page made of the given paragraphs, and its main text; boilerplate is drawn from ``others`` and from stock labels."""
    esc = entities.escape
    tell = rng.random() < 0.7  # class names and tags that give their place away

    def box(tags: tuple[str, ...], names: tuple[str, ...], inner: str) -> str:
        tag = rng.choice(tags) if tell else "div"
        name = rng.choice(("class", "id")) + f'="{rng.choice(names)}"' if tell and rng.random() < 0.8 else ""
        return f"<{tag} {name}>{inner}</{tag}>" if name else f"<{tag}>{inner}</{tag}>"

    words = " ".join(others + _LABELS).split()
    phrase = lambda a, b: " ".join(rng.choice(words) for _ in range(rng.randint(a, b)))
    sentence = lambda: phrase(4, 14).capitalize() + "."
    link = lambda: f'<a href="/{rng.randint(0, 999)}">{esc(rng.choice(_LABELS) if rng.random() < 0.4 else phrase(1, 3))}</a>'
    menu = lambda: box(("nav", "div", "ul"), ("menu", "nav", "navigation", "breadcrumb"), "<ul>" + "".join(
        f"<li>{link()}</li>" for _ in range(rng.randint(2, 8))) + "</ul>")
    extra = {
        "ad": lambda: box(("div", "aside"), ("ad", "advert", "promo-box", "sponsored"), esc(sentence() + " " * rng.randint(0, 1) + phrase(0, 8))),
        "notice": lambda: box(("div", "section"), ("cookie-notice", "notice", "alert", "consent"), f"<p>{esc(sentence())} {link()}</p>"),
        "side": lambda: box(("aside", "div"), ("sidebar", "widget", "related"), f"<h3>{esc(phrase(1, 3))}</h3><ul>" + "".join(
            f"<li>{link()}</li>" for _ in range(rng.randint(2, 6))) + f"</ul><p>{esc(sentence())}</p>" * rng.randint(0, 1)),
        "form": lambda: f"<form action='/s'><label>{esc(phrase(1, 4))}</label><input><p>{esc(sentence())}</p><button>{esc(phrase(1, 2))}</button></form>",
        "comment": lambda: box(("section", "div"), ("comments", "comment-list", "replies"), f"<h2>{esc(phrase(1, 2))}</h2>" + "".join(
            box(("div", "article", "li"), ("comment", "comment reply"), f"<p>{esc(phrase(1, 2))}</p><p>{esc(' '.join(sentence() for _ in range(rng.randint(1, 3))))}</p>")
            for _ in range(rng.randint(1, 4)))),
        "foot": lambda: box(("footer", "div"), ("footer", "site-footer", "legal"), f"&copy; {esc(phrase(1, 3))} &middot; {esc(sentence())} {link()}"),
        "head": lambda: box(("header", "div"), ("header", "masthead", "topbar"), f"<p>{esc(phrase(1, 4))}</p>" + (menu() if rng.random() < 0.5 else "")),
    }
    body = [f"<h1>{esc(title)}</h1>"] if title else []
    main = [title] if title else []
    inside = rng.random() < 0.25
    for p in paragraphs:
        kind = rng.random()
        body.append(f"<p><b>{esc(p)}<br>" if kind < 0.1 else f"<blockquote><p>{esc(p)}</p></blockquote>" if kind < 0.15
                    else f"<h2>{esc(p)}</h2>" if len(p) < 60 and kind < 0.4 else f"<p>{esc(p)}</p>")
        main.append(p)
        if inside and rng.random() < 0.2:
            body.append(rng.choice([extra["ad"], extra["form"], extra["side"]])())
    if tell or rng.random() < 0.5:
        core = rng.choice(["<article>%s</article>", "<main>%s</main>", "<main><article>%s</article></main>", '<div class="content">%s</div>',
                           '<div id="post" class="entry-content">%s</div>', "<section>%s</section>"]) % "".join(body)
    else:
        core = f"<div>{''.join(body)}</div>"
    before = [extra[k]() for k in ("notice", "head", "ad", "form") if rng.random() < 0.4]
    before.insert(rng.randint(0, len(before)), menu())
    after = [extra[k]() for k in ("comment", "side", "ad", "form", "notice") if rng.random() < 0.4] + [extra["foot"]()]
    return f"<html><head><title>{esc(title)}</title></head><body>{''.join(before)}{core}{''.join(after)}</body></html>", "\n".join(main)


def _labelled(html: str, main: list[str]) -> tuple[list[Block], list[int]]:
    """Labels of a made page's blocks: main text is met in order, up to the white space inside."""
    blocks, left = blocks_of(html), [" ".join(m.split()) for m in main]
    labels, i = [], 0
    for b in blocks:
        hit = i < len(left) and b.text == left[i]
        labels.append(int(hit))
        i += hit
    return blocks, labels


def fit(pages: DataFrame, size: int = TRAIN_PAGES, seed: int = 7) -> Chain:
    n = pages.count()
    drawn = pages.filter("html IS NOT NULL").filter(
        F.pmod(F.xxhash64(F.lit(seed), "html"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, 1.5 * size / max(n, 1))) + 1)
    ordered = drawn.select("html").distinct().orderBy(F.xxhash64(F.lit(seed + 1), "html"), "html").limit(size)
    sampled = [r["html"] for r in ordered.collect() if len(r["html"]) < 200_000]
    rng, examples = random.Random(seed), []
    for html in sorted(sampled):
        blocks = blocks_of(html)
        marked = [int("article" in b.ancestors or "main" in b.ancestors) for b in blocks]
        if sum(marked) < 2:
            continue
        examples.append((blocks, marked))
        own = [b for b, m in zip(blocks, marked) if m]
        title = own[0].text if own[0].tag == "h1" else ""
        texts = [b.text for b in own[bool(title):]] or [own[0].text]
        others = [b.text for b, m in zip(blocks, marked) if not m] or _LABELS
        for _ in range(LAYOUTS):
            made, main = layouts(title if rng.random() < 0.8 else "", texts[:rng.randint(1, 12)], others, rng)
            examples.append(_labelled(made, main.split("\n")))
    if not examples:
        for _ in range(100):
            made, main = layouts(rng.choice(_PLAIN)[:40], [rng.choice(_PLAIN) for _ in range(rng.randint(1, 8))], _LABELS, rng)
            examples.append(_labelled(made, main.split("\n")))
    return train(examples)


def main_text(html: str | None, chain: Chain) -> str:
    blocks = blocks_of(html or "")
    return "\n".join(b.text for b, y in zip(blocks, chain.label(blocks)) if y)


def extract(pages: DataFrame, chain: Chain) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    @F.pandas_udf("string")
    def run(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, chain) for h in html], dtype=object)

    return pages.select("page_id", "url", run("html").alias("text")).withColumn("n_chars", F.char_length("text").cast("bigint"))
