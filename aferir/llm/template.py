"""Main text of web pages by equivalence classes of tokens.

A page is a sequence of tokens: an element with its path of open elements, or a text outside the article
with its path. Across the pages of a host, tokens that occur equally often on every page have one
occurrence vector and form a class; vectors are compared by a sum of hashes of (page, count), which
Spark adds up without gathering a host. Classes on at least half of a host's pages are kept, checked for
order (a class must open its elements in one order) and nested by path into the host's template. Text
tokens of the template are its fixed words; elements of the template with text below them are its slots.
The slot that holds the article is the article or main element of the template, else the element with
most slot text that is no menu, header, footer or the like. Extraction walks each page with its host's
template and keeps the text of that slot without nested boilerplate.

Hosts with fewer than three pages have no vectors to compare; their pages are read with the marks of the
elements alone.

Edge cases: null or empty html gives an empty text; unclosed elements end with their parent; a page that
lacks the template's slot is read by its own marks; a null url is a host of its own; repeated pages are
extracted alike and count as pages; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aferir.llm.common import stored
from aferir.session import broadcast_if_small

SUPPORT, FEWEST_PAGES = 0.5, 3
#: An element with this share of the text is a wrapper, whatever its class or id.
WRAPPER = 0.8

# A comment, an element whose content is no text, a tag, or a declaration.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|select|textarea|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+)>"""
    r"|<[!?/][^>]*>",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strong sub sup time tt u var wbr".split()
)
# An open element of the left kind ends where one of the right kind starts.
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
    ),
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr",)),
    "td": frozenset(("td", "th", "tr")),
    "th": frozenset(("td", "th", "tr")),
    "option": frozenset(("option",)),
}
MAIN = frozenset(("article", "main"))
# Elements and names in class or id that hold no article text.
OUTSIDE_TAGS = frozenset("head nav header footer aside form button menu dialog".split())
INSIDE_TAGS = frozenset("nav footer aside form button menu dialog".split())
OUTSIDE_NAMES = frozenset(
    "nav navbar navigation menu header masthead footer sidebar breadcrumb breadcrumbs pagination pager login signup skip toolbar topbar".split()
)
INSIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent notice notices alert "
    "comment comments disqus replies sidebar share sharing social related newsletter subscribe popup modal widget menu nav".split()
)


def named(rest: str) -> tuple[str, frozenset[str]]:
    """Class and id of a tag as written, and the words in them."""
    if "=" not in rest:
        return "", frozenset()
    values = [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in ATTRIBUTE.finditer(rest)]
    label = "".join(f".{value}" for _, value in values)
    return label, frozenset(re.split(r"[^a-z0-9]+", label)) - {""}


class Walk:
    """One pass over a page: calls ``opened`` and ``text`` with the path of open elements."""

    def __init__(self, source: str) -> None:
        self.stack: list[tuple[str, str, frozenset[str]]] = []
        at = 0
        for match in TOKEN.finditer(source):
            if match.start() > at:
                self.text(source[at : match.start()])
            at = match.end()
            name = match["name"]
            if name is None:
                if match["raw"]:
                    self.gap()
                continue
            name = name.lower()
            if match["close"]:
                self.close(name)
                continue
            while self.stack and name in CLOSED_BY.get(self.stack[-1][0], ()):
                self.stack.pop()
                self.closed()
            if name not in INLINE:
                self.gap()
            if name in VOID:
                continue
            label, words = named(match["rest"])
            self.stack.append((name, label, words))
            self.opened()
        if at < len(source):
            self.text(source[at:])

    def close(self, name: str) -> None:
        if name not in INLINE:
            self.gap()
        for place in range(len(self.stack) - 1, -1, -1):
            if self.stack[place][0] == name:
                while len(self.stack) > place:
                    self.stack.pop()
                    self.closed()
                return

    @property
    def path(self) -> str:
        return "/".join(name + label for name, label, _ in self.stack)

    def opened(self) -> None: ...

    def closed(self) -> None: ...

    def gap(self) -> None: ...

    def text(self, raw: str) -> None: ...


def plain(raw: str) -> str:
    return html.unescape(raw) if "&" in raw else raw


class Tokens(Walk):
    """Counts of a page's tokens, the place where each is first seen, and the characters below each path."""

    def __init__(self, source: str) -> None:
        self.count: dict[str, int] = defaultdict(int)
        self.first: dict[str, int] = {}
        self.chars: dict[str, int] = defaultdict(int)
        super().__init__(source)

    def seen(self, token: str) -> None:
        self.count[token] += 1
        self.first.setdefault(token, len(self.first))

    def opened(self) -> None:
        if self.stack[-1][0] not in INLINE:
            self.seen(self.path)

    def text(self, raw: str) -> None:
        words = " ".join(plain(raw).split())
        if not words:
            return
        path = self.path
        self.chars[path] += len(words)
        if not any(name in MAIN for name, _, _ in self.stack):
            token = f"{path}\t{xxhash.xxh64_hexdigest(words)}"
            self.seen(token)
            self.chars[token] += len(words)


def host_of(url: str | None) -> str:
    match = re.match(r"[a-z][a-z0-9+.-]*://([^/?#]*)", url or "", re.IGNORECASE)
    return match[1].lower() if match else ""


OCCURRENCES = "host string, token string, support long, total long, vector long, place double, chars long"


def occurrences(pages: DataFrame) -> DataFrame:
    """Per host and token: pages with it, occurrences, hash of its vector, mean place, characters.

    The empty token stands for the page itself, so its support is the host's number of pages.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums: dict[tuple[str, str], list] = defaultdict(lambda: [0, 0, 0, 0.0, 0])
            for url, source in zip(batch["url"], batch["html"], strict=True):
                host, page, tokens = host_of(url), xxhash.xxh64_intdigest(f"{url}\t{source}"), Tokens(source or "")
                tokens.count[""] = 1
                for token, n in tokens.count.items():
                    row = sums[host, token]
                    row[0] += 1
                    row[1] += n
                    row[2] += xxhash.xxh64_intdigest(str(n), page) >> 8
                    row[3] += tokens.first.get(token, -1)
                    row[4] += tokens.chars.get(token, 0)
            rows = [(h, t, s, n, v % (1 << 56), p, c) for (h, t), (s, n, v, p, c) in sums.items()]
            yield pd.DataFrame(rows, columns=[field.split()[0] for field in OCCURRENCES.split(", ")])

    counted = pages.select("url", "html").mapInPandas(count, OCCURRENCES)
    summed = counted.groupBy("host", "token").agg(
        F.sum("support").alias("support"),
        F.sum("total").alias("total"),
        F.sum(F.col("vector").cast("decimal(20,0)")).alias("vector"),
        (F.sum("place") / F.sum("support")).alias("place"),
        F.sum("chars").alias("chars"),
    )
    # Batches add hashes modulo 2^56, so sums agree up to that only.
    return summed.withColumn("vector", F.expr("cast(mod(vector, 72057594037927936) as long)"))


def frequent(counted: DataFrame) -> DataFrame:
    """One row per host with enough pages: its tokens on at least half of them."""
    counted = counted.where(F.col("support") >= FEWEST_PAGES)
    pages = counted.where("token = ''").select("host", F.col("support").alias("n_pages"))
    tokens = counted.where("token <> ''").join(pages, "host").where(F.col("support") >= SUPPORT * F.col("n_pages"))
    token = F.struct("token", "support", "total", "vector", "place", "chars")
    # A token is on half of the pages, so a host has twice as many as a page, at most.
    return tokens.groupBy("host").agg(F.sort_array(F.collect_list(token)).alias("tokens"))


def inner(stack: tuple[str, ...], place: int) -> bool:
    return any(part.split(".")[0] in MAIN for part in stack[:place])


def boilerplate(tag: str, words: frozenset[str], inside: bool) -> bool:
    if inside:
        return tag in INSIDE_TAGS or bool(words & INSIDE_NAMES)
    return tag in OUTSIDE_TAGS or bool(words & (INSIDE_NAMES | OUTSIDE_NAMES))


def is_boilerplate(path: str, wrappers: frozenset[str] = frozenset(), own: bool = True) -> bool:
    """Whether an element of the path holds no article text; without ``own`` the last one's names do not count."""
    stack = tuple(path.split("/"))
    for place, part in enumerate(stack):
        tag, _, label = part.partition(".")
        words = frozenset(re.split(r"[^a-z0-9]+", label)) - {""}
        if "/".join(stack[: place + 1]) in wrappers or not own and place == len(stack) - 1:
            words = frozenset()
        if boilerplate(tag, words, inner(stack, place)):
            return True
    return False


def wrapping(chars: dict[str, int]) -> frozenset[str]:
    """The paths with nearly all of the text below them, and those of html and body; ``chars`` is by path."""
    below: dict[str, int] = defaultdict(int)
    chars = {path: n for path, n in chars.items() if "\t" not in path}
    for path, n in chars.items():
        parts = path.split("/")
        for place in range(1, len(parts) + 1):
            below["/".join(parts[:place])] += n
    whole = sum(chars.values())
    roots = {path for path in below if path.split("/")[-1].split(".")[0] in ("html", "body")}
    return frozenset(roots | {path for path, n in below.items() if n >= WRAPPER * whole})


def template(tokens: list) -> tuple[str, list[str]]:
    """The path of the article's slot and the fixed texts of a host, from its classes."""
    classes: dict[tuple, list] = defaultdict(list)
    for token in tokens:
        classes[token["support"], token["total"], token["vector"]].append(token)
    members: dict[str, list] = {}
    for group in classes.values():
        group.sort(key=lambda token: token["place"])
        opened: set[str] = set()
        for token in group:
            path = token["token"].split("\t")[0]
            # In order: an element of the class comes after those of the class that it is inside.
            inside = [other["token"] for other in group if path.startswith(other["token"] + "/")]
            if all(other in opened for other in inside):
                opened.add(path)
                members[token["token"]] = group
    fixed = sorted(token for token in members if "\t" in token)
    paths = [token for token in members if "\t" not in token]
    # Names on what wraps nearly everything say nothing; those of an article itself only if there is another.
    held: dict[str, int] = defaultdict(int)
    for token in tokens:
        if "\t" not in token["token"]:
            held[token["token"]] += token["chars"]
    wrappers = wrapping(held)
    every = [path for path in paths if path.split("/")[-1].split(".")[0] in MAIN]
    main = [path for path in every if not is_boilerplate(path, wrappers)]
    main = main or [path for path in every if not is_boilerplate(path, wrappers, own=False)]
    if main:
        return min(main, key=lambda path: (path.count("/"), path)), fixed
    # Slot text: what is below a path without the fixed texts.
    chars: dict[str, int] = defaultdict(int)
    for token in tokens:
        path, _, text = token["token"].partition("\t")
        if not text or token["token"] in members:
            chars[path] += -token["chars"] if text else token["chars"]
    below = {
        path: sum(n for other, n in chars.items() if (other == path or other.startswith(path + "/")) and not is_boilerplate(other, wrappers))
        for path in paths
        if not is_boilerplate(path, wrappers) and members[path][0]["support"] == members[path][0]["total"]
    }
    whole = max(below.values(), default=0)
    # The deepest element, once on a page, that still has nearly all of the slot text.
    rich = [path for path, n in below.items() if whole and n >= 0.9 * whole]
    return max(rich, key=lambda path: (path.count("/"), path), default=""), fixed


class Extract(Walk):
    """The text of a page's article."""

    #: Whether the whole page counts as the slot.
    whole = False

    def __init__(
        self, source: str, slot: str, fixed: frozenset[str], page_marks: bool = False, wrappers: frozenset[str] = frozenset()
    ) -> None:
        self.slot, self.fixed, self.page_marks, self.wrappers = slot, fixed, page_marks, wrappers
        self.parts: list[str] = []
        self.inside: list[bool] = []  # per open element: part of the slot
        self.dropped: list[bool] = []  # per open element: boilerplate
        super().__init__(source)

    def opened(self) -> None:
        tag, label, words = self.stack[-1]
        in_main = inside = bool(self.inside and self.inside[-1])
        if not inside:
            inside = tag in MAIN if self.page_marks else bool(self.slot) and self.path == self.slot
        if self.whole:
            inside, in_main = True, any(name in MAIN for name, _, _ in self.stack[:-1])
        dropped = bool(self.dropped and self.dropped[-1])
        if self.slot and not in_main:
            dropped = False  # the slot and what it is in were judged with the template
        elif not dropped:
            # On the page's own marks the article's names do not count, nor those of what wraps nearly everything.
            plain_tag = bool(words) and (self.path in self.wrappers or self.page_marks and inside and not in_main)
            dropped = boilerplate(tag, frozenset() if plain_tag else words, in_main)
        self.dropped.append(dropped)
        self.inside.append(inside)

    def closed(self) -> None:
        self.inside.pop()
        self.dropped.pop()

    def gap(self) -> None:
        self.parts.append(" ")

    def text(self, raw: str) -> None:
        if not self.inside or not self.inside[-1] or self.dropped[-1]:
            return
        found = plain(raw)
        if self.fixed and not any(name in MAIN for name, _, _ in self.stack):
            words = " ".join(found.split())
            if words and f"{self.path}\t{xxhash.xxh64_hexdigest(words)}" in self.fixed:
                return
        self.parts.append(found)

    @property
    def joined(self) -> str:
        return " ".join("".join(self.parts).split())


class Body(Extract):
    """Everything on the page that is no boilerplate: for pages without an article element."""

    whole = True

    def text(self, raw: str) -> None:
        if not self.stack:
            self.parts.append(plain(raw))
        else:
            super().text(raw)


def main_text(source: str | None, slot: str = "", fixed: frozenset[str] = frozenset()) -> str:
    """The article of a page: the template's slot, else the page's own article, else what is no boilerplate; the first with text."""
    if not source:
        return ""
    if slot:
        found = Extract(source, slot, fixed).joined
        if found:
            return found
    wrappers = wrapping(Tokens(source).chars)
    found = Extract(source, "", fixed, page_marks=True, wrappers=wrappers).joined
    return found or Body(source, "", fixed, wrappers=wrappers).joined


TEXTS = "page_id long, url string, text string, n_chars long"


def templates(pages: DataFrame) -> DataFrame:
    """Per host: the path of the article's slot and its fixed texts."""

    def deduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [template([dict(token) for token in tokens]) for tokens in batch["tokens"]]
            yield pd.DataFrame(
                {"host": batch["host"], "slot": [slot for slot, _ in found], "fixed": [fixed for _, fixed in found]}
            )

    return frequent(occurrences(pages)).mapInPandas(deduce, "host string, slot string, fixed array<string>")


def extract_texts(pages: DataFrame) -> DataFrame:
    """One row per page with its main text."""
    known = broadcast_if_small(stored(templates(pages)))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    joined = pages.withColumn("host", host).join(known, "host", "left").drop("host")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [
                main_text(source, slot or "", frozenset(() if fixed is None else fixed))
                for source, slot, fixed in zip(batch["html"], batch["slot"], batch["fixed"], strict=True)
            ]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"].astype("Int64"),
                    "url": batch["url"],
                    "text": texts,
                    "n_chars": [len(text) for text in texts],
                }
            )

    return joined.mapInPandas(extract, TEXTS)
