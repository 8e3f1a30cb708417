"""Main text of web pages by equivalence-class template deduction.

The tokens of a page are its elements, named by their path from the root, and
the words of its text, named by their element's path and their number among
equal words of their block.  Over all pages of a host, tokens with the same
occurrence vector (how often each distinct page has them) form an equivalence
class.  Classes found on most pages are valid; an element path nests in the
class of its nearest valid ancestor.  A word in the class of an element around
it is template text: the element never comes without it.  Blocks of nothing but
template text are dropped; a block with other words is a slot and stays whole.

The slot of the article is an article or main element, else the deepest token
in the class of the root that holds nearly all of the text.  Tags and class
words (menus, notices, adverts, forms, comments) drop further branches, the
words only below or beside the slot: an element that holds it, or most of the
text, stays whatever its name.

Occurrence vectors are never built: a class is known by the sum of hashes of
(page, count), which combines before the shuffle.  A word in the class of an
element is on every page that has the element it is in, so each task first
keeps, by host and path, the words that all its pages with the path have; a bit
field, of fixed size, of those that every task has kept tells the second pass
which words to sum.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from salesmart.llm.common import Cache, lane, land, shuffle_width
from salesmart.llm.url_filter import host_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Elements whose content is never article text, wherever they are.
DROPPED = frozenset(
    "head title script style noscript template iframe object svg math canvas nav footer aside form button select"
    " option textarea input label dialog menu".split()
)
# Words of class, id and role that name something else than the article.
OTHER = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisement|banner|promo|promoted|sponsor|sponsored|cookies?|consent|notices?|alert"
    r"|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|breadcrumbs?|menu"
    r"|nav|navbar|navigation|sidebar|footer|masthead|comments?|commentlist|respond|replies|disqus|widget|toolbar|pagination)(?:$|[^a-z])"
).search
# Within the article only names made of nothing but such words, at least one of the first kind, say so ("related-posts",
# not "related-work").
_OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement banner promo promoted sponsor sponsored cookie cookies consent notice notices alert popup modal overlay"
    " newsletter subscribe signup login share sharing social related recommended breadcrumb breadcrumbs menu nav navbar navigation sidebar"
    " footer masthead comment comments commentlist respond replies disqus widget toolbar pagination".split()
)
_PLACE_WORDS = frozenset(
    "a area article articles bar block bottom box buttons center container content entry form global header icons inner inline item items"
    " left links list main media mid middle more outer page panel post posts primary right secondary section site slot small stories story"
    " thread top unit wrap wrapper".split()
)
_PARTS = re.compile(r"[a-z]+").findall
# Names that tell what an element has beside it, not what it is ("no-sidebar").
_ABOUT = re.compile(r"(?:no|has|with|without|is)-").match
# An open element of the first kind ends when one of the second begins inside it.
_ENDS_BEFORE = {
    "p": BLOCK,
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
_SCOPES = frozenset("html body article section main div table ul ol dl td th blockquote nav header footer aside form".split())
_START = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*+>|<(/?)([a-zA-Z][^\s/<>]*+)", re.DOTALL)
_RAW = {n: re.compile(rf"</{n}\s*+>", re.IGNORECASE) for n in "script style noscript textarea template iframe svg".split()}
_STOP = re.compile(r"""[<>]|=\s*+(["'])""")
_ATTRIBUTE = re.compile(r"""([^\s=/"']++)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|(\S*+)))?+""")
_DIGITS = re.compile(r"\d+")
ARTICLE = r"/(article|main)(\.[^/]*)?$"  # paths of article elements
DEPTH = 100  # elements nested deeper share the path of this depth


@dataclass(frozen=True)
class Template:
    min_share: float = 0.5  # of a host's pages that a valid class is on
    main_share: float = 0.9  # of the text that the slot of the article holds
    min_pages: int = 10  # distinct pages of a host from which its words can be template text


class _Element:
    __slots__ = ("name", "path", "out", "other", "main")

    def __init__(self, name: str, path: str, out: bool, other: str, main: bool):
        self.name, self.path, self.out, self.other, self.main = name, path, out, other, main


def markup(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, is an end tag, attributes) of every tag; names are empty for comments and elements of raw text.

    A quoted value may be of any length and hold anything.  Quotes without an end are plain characters; whether
    one follows is remembered per kind, as are the values from which no tag ends, so all takes linear time.
    """
    at = 0
    unclosed: set[str] = set()
    dead: set[int] = set()
    while m := _START.search(page, at):
        at = m.end()
        if m.group(2) is None:
            yield m.start(), at, "", False, ""
            continue
        values, i, end = [], at, -1
        while stop := _STOP.search(page, i):
            i, quote = stop.end(), stop.group(1)
            if quote is None:
                end = i if stop.group() == ">" else -1
                break
            if i in dead:
                break
            values.append(i)
            close = -1 if quote in unclosed else page.find(quote, i)
            if close < 0:
                unclosed.add(quote)
            else:
                i = close + 1
        if end < 0:
            dead.update(values)
            continue
        name, attributes = m.group(2).lower(), page[at : end - 1]
        at = end
        if name in _RAW and not m.group(1):
            close = _RAW[name].search(page, end)
            at = close.end() if close else len(page)
            name = ""
        yield m.start(), at, name, bool(m.group(1)), attributes


def walk(page: str):
    """Events of a page: ("open", element), ("text", element around it, text) and ("break",).

    An element's ``out`` is set inside tags that are dropped anywhere, ``other`` is the path of the innermost
    element around it, or itself, whose names tell something else than the article.
    """
    top = _Element("", "", False, "", False)
    stack = [top]
    at = 0
    for start, end, name, closing, attributes in markup(page):
        if start > at:
            yield "text", stack[-1], page[at:start]
        at = end
        if not name:
            continue
        if closing:  # an end tag closes its element and all in it; one without a start is void
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
        elif name not in VOID:
            for k in range(len(stack) - 1, 0, -1):
                if name in _ENDS_BEFORE.get(stack[k].name, ()):
                    del stack[k:]
                    break
                if stack[k].name in _SCOPES:
                    break
            above = stack[-1]
            names = []
            if attributes:
                names = [n for a in _ATTRIBUTE.findall(attributes) if a[0].lower() in ("class", "id", "role") for n in (a[1] or a[2] or a[3]).lower().split()]
            own = "main" in names or name in ("article", "main")
            # A header inside the article is the article's own; so are names on the page's frame.
            out = above.out or name in DROPPED or (name == "header" and not above.main)
            token = ".".join([name, *sorted(_DIGITS.sub("N", n) for n in names)])
            path = f"{above.path}/{token}" if len(stack) <= DEPTH else above.path
            named = names and name not in ("html", "body") and not own and _something_else(names, above.main)
            stack.append(_Element(name, path, out, path if named else above.other, above.main or own))
            yield "open", stack[-1], ""
        elif name == "br":
            yield "text", stack[-1], " "
        if name in BLOCK:
            yield "break", stack[-1], ""
    if at < len(page):
        yield "text", stack[-1], page[at:]


def _something_else(names: list[str], in_article: bool) -> bool:
    """Whether names of an element say that it is something else than the article."""
    names = [n for n in names if not _ABOUT(n)]
    if not in_article:
        return OTHER(" ".join(names)) is not None
    parts = [set(_PARTS(n)) for n in names]
    return any(p & _OTHER_WORDS and p <= _OTHER_WORDS | _PLACE_WORDS for p in parts)


_MASK = (1 << 64) - 1
_NUMBER = Cache(lambda s: int.from_bytes(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))


def _word_key(path: str, token: str) -> int:
    """Number of a word token; that of an element is ``_NUMBER[path]``."""
    return _NUMBER[path] ^ ((_NUMBER[token] + 0x9E3779B97F4A7C15) & _MASK)


def _token(word: str, nth: int) -> str:
    return f"{word} {nth}" if nth else word


def _signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


def _holds(path: str, below: str) -> bool:
    return path == below or below.startswith(f"{path}/")


class Tokens:
    """Of a page: ``count`` by element path (the root "" included), ``chars`` of text below each without branches named
    otherwise, ``other`` paths that are in such a branch themselves, characters of all text (``full``), and
    ``words``: by path the occurrences of its words, for paths that are ``wanted``."""

    def __init__(self, page: str, wanted: Callable[[str], bool] = lambda path: True):
        self.count: dict[str, int] = {"": 1}
        self.other: set[str] = set()
        self.full = 0
        self.words: dict[str, Counter[str]] = {}
        direct: dict[tuple[str, str], int] = {}
        seen: dict[str, Counter[str]] = {}
        for kind, element, text in walk(page):
            if kind == "break":
                seen.clear()
            elif element.out:
                continue
            elif kind == "open":
                self.count[element.path] = self.count.get(element.path, 0) + 1
                if element.other:
                    self.other.add(element.path)
            elif words := text.split():
                path = element.path
                key = (path, element.other)
                direct[key] = direct.get(key, 0) + sum(map(len, words))
                if not wanted(path):
                    continue
                before = seen.setdefault(path, Counter())
                if before or len(set(words)) < len(words):
                    tokens = []
                    for w in words:
                        tokens.append(_token(w, before[w]))
                        before[w] += 1
                else:
                    before.update(words)
                    tokens = words
                self.words.setdefault(path, Counter()).update(tokens)
        self.chars = dict.fromkeys(self.count, 0)
        for (path, other), n in direct.items():
            self.full += n
            while True:
                self.chars[path] = self.chars.get(path, 0) + n
                if path == other:  # "" too, the root
                    break
                path = path.rpartition("/")[0]


def main_text(page: str, slot: str | None, template: frozenset[int] = frozenset()) -> str:
    """The blocks of the slot joined by newlines, without those made of ``template`` words only.

    A page without the slot gives its article, else the branch that holds most of its text where that is named
    otherwise, else all that is not dropped.
    """
    blocks: list[tuple[str, bool, bool, str, bool]] = []
    parts: list[str] = []
    state = (False, False, "")
    fixed = bool(template)
    seen: dict[tuple[str, str], int] = {}

    def close() -> None:
        if parts and (text := " ".join(references.unescape("".join(parts)).split())):
            blocks.append((text, *state, fixed))
        parts.clear()

    for kind, element, text in walk(page):
        if kind == "break":
            close()
            seen.clear()
            fixed = bool(template)
        elif kind == "text" and not element.out:
            here = slot is not None and _holds(slot, element.path)
            other = "" if here and _holds(element.other, slot) else element.other
            if parts and (here, element.main, other) != state:
                close()
            state = (here, element.main, other)
            parts.append(text)
            if fixed:  # a block is template text as long as all its words are
                path = element.path
                for w in text.split():
                    nth = seen[path, w] = seen.get((path, w), -1) + 1
                    if _signed(_word_key(path, _token(w, nth))) not in template:
                        fixed = False
                        break
    close()
    plain = [b for b in blocks if not b[3]]
    chosen = [b for b in plain if b[1]] or [b for b in plain if b[2]]
    if not chosen:
        sizes: dict[str, int] = {}
        for b in blocks:
            sizes[b[3]] = sizes.get(b[3], 0) + len(b[0])
        most = max(sizes, key=sizes.__getitem__, default="")
        most = most if 2 * sizes.get(most, 0) > sum(sizes.values()) else ""
        branch = [b for b in blocks if b[3] == most]
        chosen = [b for b in branch if b[2]] or branch
    return "\n".join(b[0] for b in chosen if not b[4])


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for row in zip(*(batch.column(k) for k in range(batch.num_columns)), strict=True):
            yield tuple(v.as_py() for v in row)


_STATS = "host string, key bigint, path string, word string, n_tasks bigint, n_pages bigint, occurrences bigint, chars bigint, full_chars bigint, other boolean"
_STATS_ARROW = pa.schema(
    [("host", pa.string()), ("key", pa.int64()), ("path", pa.string()), ("word", pa.string())]
    + [(n, pa.int64()) for n in ("n_tasks", "n_pages", "occurrences", "chars", "full_chars")]
    + [("other", pa.bool_())]
)
HELD = 200_000  # words that a task holds before it gives out what it knows and begins anew


class _Host:
    """What a task knows of a host: sums by element path, and the words that all pages with a path have there."""

    __slots__ = ("paths", "words")

    def __init__(self):
        self.paths: dict[str, list] = {}
        self.words: dict[str, set[str]] = {}

    def add(self, page: str) -> int:
        """Words held more than before."""
        t = Tokens(page, lambda path: path not in self.words or bool(self.words[path]))
        held = 0
        for path, chars in t.chars.items():
            s = self.paths.setdefault(path, [1, 0, 0, 0, 0, False])
            s[1] += 1
            s[2] += t.count.get(path, 1)
            s[3] += chars
            s[4] += 0 if path else t.full
            s[5] = s[5] or path in t.other
            here = t.words.get(path, ())
            if (words := self.words.get(path)) is None:
                self.words[path] = set(here)
                held += len(here)
            elif words:
                self.words[path] = {w for w in words if w in here}
                held += len(self.words[path]) - len(words)
        return held


def stats_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: (host, html) to ``_STATS``: partial sums of all element paths, and the words that all of the
    pages with a path have there."""
    hosts: dict[str, _Host] = {}
    held = 0

    def found() -> Iterator[pa.RecordBatch]:
        rows = []
        for name, h in hosts.items():
            rows += [(name, _signed(_NUMBER[p]), p, None, *s) for p, s in h.paths.items()]
            rows += [(name, _signed(_word_key(p, w)), p, w, 1, 0, 0, 0, 0, False) for p, words in h.words.items() for w in words]
        hosts.clear()
        for at in range(0, len(rows), 10_000):
            columns = zip(*rows[at : at + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _STATS_ARROW, strict=True)], schema=_STATS_ARROW)

    for name, page in _pages(batches):
        held += hosts.setdefault(name, _Host()).add(page or "")
        if held > HELD:
            yield from found()
            held = 0
    yield from found()


FIELD = 1 << 20  # bits that tell candidate tokens from others; a few tokens more are sent and sorted out later


def _field_bit(host: str, key: int) -> int:
    return (_NUMBER[host] ^ key) % FIELD


def _with_words(path: str) -> int:
    """Number that tells that a path has candidate words."""
    return _word_key(path, "")


def bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: (host, key, path of a word or null) to the bits of the field, each once in a task."""
    bits = np.zeros(FIELD, bool)
    for host, key, path in _pages(batches):
        bits[_field_bit(host, key & _MASK)] = True
        if path is not None:
            bits[_field_bit(host, _with_words(path))] = True
    yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(bits).astype(np.int32))], ["bit"])


def counts_of(field: bytes):
    """mapInArrow function: (host, content, html) to (host, content, keys, counts) of the tokens in the field."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, content, page in _pages(iter([batch])):

                def known(key: int, host: str = host) -> int:
                    bit = _field_bit(host, key)
                    return field[bit >> 3] >> (bit & 7) & 1

                t = Tokens(page or "", lambda path, known=known: bool(known(_with_words(path))))
                n = {_NUMBER[p]: c for p, c in t.count.items()} | {_word_key(p, w): c for p, ws in t.words.items() for w, c in ws.items()}
                kept = [k for k in n if known(k)]
                rows.append((host, content, [_signed(k) for k in kept], [n[k] for k in kept]))
            if rows:
                kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()))
                arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["host", "content", "keys", "counts"])

    return counts


def text_udf():
    """Column function: html, slot and template words to (text, n_chars)."""

    @arrow_udf("text string, n_chars bigint")
    def extracted(pages: pa.Array, slots: pa.Array, templates: pa.Array) -> pa.Array:
        texts = []
        sets = Cache(frozenset, limit=1000, longest=1 << 62)
        for p, s, t in zip(pages, slots, templates, strict=True):
            texts.append(main_text(p.as_py() or "", s.as_py(), sets[tuple(t.as_py() or ())]))
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["text", "n_chars"])

    return extracted


def templates(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", how: Template = Template()) -> DataFrame:
    """The valid tokens of every host: host, path, word (null for elements), key, class_id, parent (class of the nearest
    valid ancestor; for words that of an element around them that has their class), n_pages, occurrences, chars,
    other (in a branch named otherwise), once (in the root's class) and main (it holds the text)."""
    pages = df.select(host_of(F.col(url_col)).alias("host"), F.xxhash64(F.col(html_col)).alias("content"), F.col(html_col).alias("html"))
    stats = pages.select("host", "html").mapInArrow(stats_of, _STATS)
    sums = [F.sum(n).alias(n) for n in ("n_tasks", "n_pages", "occurrences", "chars", "full_chars")]
    stats = land(stats.groupBy("host", "key", "path", "word").agg(*sums, F.max("other").alias("other")), "tokens")
    whole = stats.where("path = '' and word is null").select(
        "host", F.col("n_pages").alias("pages"), F.col("chars").alias("plain_chars"), F.col("full_chars").alias("all_chars")
    )
    found = stats.drop("full_chars").join(whole, "host")
    likely = found.where(F.col("word").isNull() & (F.col("n_pages") >= how.min_share * F.col("pages")))
    # Words that every task with pages of their path has kept.
    everywhere = likely.select("host", "path", "n_tasks")
    likely = land(likely.unionByName(found.where("word is not null").join(everywhere, ["host", "path", "n_tasks"], "left_semi")), "likely")
    bits = np.zeros(FIELD, np.uint8)
    bits[likely.select("host", "key", F.when(F.col("word").isNotNull(), F.col("path"))).mapInArrow(bits_of, "bit int").distinct().toArrow().column("bit").to_numpy()] = 1
    field = np.packbits(bits, bitorder="little").tobytes()
    # Copies of a page are one page; its tokens meet once per content.
    sent = pages.mapInArrow(counts_of(field), "host string, content bigint, keys array<bigint>, counts array<int>")
    once = sent.groupBy("host", "content").agg(F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys"), F.first("counts").alias("counts"))
    each = once.select("host", "content", "copies", F.explode(F.arrays_zip("keys", "counts")).alias("t"))
    vector = F.sum(F.xxhash64("content", "t.counts").cast("decimal(20,0)")).alias("vector")
    classes = each.groupBy("host", F.col("t.keys").alias("key")).agg(
        vector, F.count(F.lit(1)).alias("distinct_pages"), F.sum(F.col("t.counts").cast("bigint")).alias("distinct_n"),
        F.sum("copies").alias("n_all"), F.sum(F.col("copies") * F.col("t.counts")).alias("occurs_all"),
    )
    class_id = F.xxhash64("vector", "distinct_pages", "distinct_n").alias("class_id")
    valid = land(likely.join(classes.select("host", "key", class_id, "distinct_pages", "n_all", "occurs_all"), ["host", "key"]), "classes")
    root = valid.where("path = '' and word is null").select("host", F.col("class_id").alias("root_class"), F.col("distinct_pages").alias("contents"))
    named = F.when(
        F.col("other"),
        (F.col("chars") >= how.main_share * (F.col("plain_chars") + F.col("chars")))
        & ((2 * F.col("chars") > F.col("all_chars")) | (F.col("once") & F.col("path").rlike(ARTICLE))),
    ).otherwise((F.col("chars") >= how.main_share * F.col("plain_chars")) & (F.col("chars") > 0))
    out = ["host", "path", "word", "key", "class_id", "n_pages", "occurrences", "chars", "other", "once", "main"]
    elements = valid.where("word is null and path <> ''").join(root, "host")
    elements = elements.withColumn("once", F.col("class_id") == F.col("root_class")).withColumn("main", named).select(out)
    above = elements.select("host", F.col("path").alias("above"), F.col("class_id").alias("parent"))
    nested = elements.withColumn("above", F.explode(_around(F.regexp_replace("path", "/[^/]*$", "")))).join(above, ["host", "above"])
    nearest = nested.groupBy("host", "key").agg(F.max_by("parent", F.length("above")).alias("parent"))
    elements = elements.join(nearest, ["host", "key"], "left")
    # Words on most pages, copies counted or not, in the class of an element around them.
    words = valid.where("word is not null").join(root, "host")
    words = words.where((F.col("contents") >= how.min_pages) & (F.col("n_all") >= how.min_share * F.col("pages")))
    words = words.where(F.col("distinct_pages") >= how.min_share * F.col("contents"))
    words = words.withColumn("n_pages", F.col("n_all")).withColumn("occurrences", F.col("occurs_all")).withColumn("chars", F.length(F.substring_index("word", " ", 1)) * F.col("occurs_all"))
    words = words.withColumn("once", F.col("class_id") == F.col("root_class")).withColumn("main", F.lit(False)).select(out)
    words = words.withColumn("above", F.explode(_around(F.col("path")))).join(above, ["host", "above"]).where("class_id = parent")
    return elements.unionByName(words.drop("above").dropDuplicates(["host", "key"]))


def _around(path):
    """The path and those of the elements around it, without the root."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def slots(template: DataFrame) -> DataFrame:
    """(host, slot, template): the path that holds the article, and the numbers of the words in a class around them.

    The slot is the shallowest article or main element, else the deepest token of the root's class that holds nearly
    all text; in a branch named otherwise only if that holds most of the text, or the one article of every page, and no
    article is beside it."""
    depth = F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))
    named = F.col("path").rlike(ARTICLE) & F.col("main")
    deep = F.col("once") & F.col("main")
    shallow = [F.min_by("path", F.when(named & w, F.struct(depth, "path"))) for w in (~F.col("other"), F.col("other"))]
    deepest = [F.max_by("path", F.when(deep & w, F.struct(depth, "path"))) for w in (F.col("other"), ~F.col("other"))]
    nested = F.collect_list(F.when(F.col("word").isNotNull() & (F.col("class_id") == F.col("parent")), F.col("key")))
    return template.groupBy("host").agg(F.coalesce(*shallow, *deepest).alias("slot"), F.sort_array(nested).alias("template"))


def extract_main(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", how: Template = Template()) -> DataFrame:
    """One row per row of ``df``: id, url, text and n_chars of the article.

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined in page order by one newline.  Null, empty and
    broken pages give what can be read of them, at least an empty text; a null
    URL belongs to the host without a name.  A page of any length is read whole,
    in linear time; of equally deep candidates for a host's slot the first path is
    taken.  Repeated rows stay; other columns are not read; an empty table gives
    an empty result.
    """
    own = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    found = slots(templates(own, "id", "url", "html", how))
    width = shuffle_width(df.sparkSession)
    rows = own.withColumn("host", host_of(F.col("url"))).withColumn("lane", lane(F.struct("id", "url"), width))
    # One row per host and lane, so the pages of a large host are spread over all tasks.
    by_lane = rows.select("host", "lane").distinct().join(found, "host")
    joined = rows.join(by_lane, ["host", "lane"], "left")
    out = joined.select("id", "url", text_udf()(F.col("html"), F.col("slot"), F.col("template")).alias("_t"))
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "_t.*")
