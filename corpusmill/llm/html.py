"""Main-text extraction from web pages by a suffix array of each host.

A page is cut into blocks by its markup. Blocks inside an article or main
element are the page's text, unless they sit in a part that is none by its
element, role or class. All other blocks form the page's token stream: hashed
words, with a token for the kind of place before each block and one for the
page's end.

The streams of a host's distinct pages are concatenated and their suffixes
sorted; from the sorted order come the lengths of common prefixes, and from
these the substrings of ``length`` tokens or more that stand on enough distinct
pages: two at least, and a ``share`` of the host's. They are the host's boilerplate. Blocks
that markup leaves open and that they cover go; of other blocks runs of ``length``
tokens or more that they cover are cut out, and the unique runs stay.

The articles of a host have a suffix array of their own, in which articles of
the same text count once. What authors repeat is an article's text and stays;
what stands in nearly all articles of a host, ``ARTICLES`` says of how many, is its
template: notices and adverts that no markup names. Blocks that it covers whole
go. An article that would lose more than half of its words is a version of
others and stays whole. Nothing beside an article belongs to the text, and
blocks that the markup names as menu, advert and the like go even if unique.

A host of more than ``piece`` tokens is split into pieces, each with a suffix
array of its own. What stands on a share of the pages does so in one piece at
least: a piece reports those substrings of ``length`` tokens, and they are
counted on all pages of the host; substrings of that length tell what longer
ones cover. So a host with a third of all pages is many tasks' work. What is
boilerplate stands on a share of the pages, so a host has few such substrings,
however many pages it has.

Defined cases: a null or empty html and one without text give the empty
text. A null url belongs to the host without a name. Rows that repeat a
page_id are pages of their own; pages of the same content count once in what
is repeated. Broken markup is read as far as it goes, in time that grows with
the page's length. A very long page is read whole. There are no ties. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import released, slices, table, utf8
from corpusmill.session import stored

TAG = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:"[^"]*+"|'[^']*+'|[^'">]++){0,500}+)>""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
#: Elements whose content is raw or never shown.
RAW = frozenset("script style noscript template svg iframe object canvas math head textarea select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements inside a line of text; all others begin and end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
#: Elements that an end tag of another element does not close.
REGIONS = frozenset("article main nav aside header footer form section body html table td th".split())
NOT_TEXT = frozenset("nav footer aside form button menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar".split())
#: Words of class and id names of parts that are not the page's text; the weak ones also name what an article may be about.
STRONG = frozenset(
    "nav navbar navigation menu footer sidebar ad ads advert adverts advertisement adsense sponsor sponsored promo banner cookie cookies"
    " consent gdpr popup modal newsletter subscribe signup login breadcrumb breadcrumbs comment comments pagination pager toolbar masthead"
    " copyright disqus".split()
)
WEAK = frozenset("share sharing social notice respond related recommended widget skip".split())
HEADERS = frozenset("header topbar".split())
#: Words that stand beside them in such names. A name of which another word is left says something else.
BESIDE = frozenset(
    "site page main top bottom left right primary secondary global mobile desktop box bar block container wrapper wrap inner outer area"
    " section list item items link links button buttons icon icons post posts entry form to content text bottombar row col column group slot"
    " unit label title body bg the".split()
)
HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")

TEXT, PART, OPEN = 0, 1, 2  # of the article; of a part that is no text; outside of any article


@dataclass(frozen=True)
class Params:
    """length: tokens of the shortest repeat; pages, share: distinct pages that it must stand on; piece: most tokens of a suffix array."""

    length: int = 8
    pages: int = 2
    share: float = 0.1
    piece: int = 2_000_000


#: Of articles: what stands in nine of ten of a host's, five at least, is no author's.
ARTICLES = Params(pages=5, share=0.9, piece=1_500_000)


@dataclass
class Page:
    texts: list[str] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    places: list[str] = field(default_factory=list)

    @property
    def settled(self) -> bool:
        """Whether the page's text is known without regard to other pages."""
        return TEXT in self.kinds or OPEN not in self.kinds


class _Open:
    """The elements that are open, with the places of each name, of regions and of blocks among them, so that no tag looks through them all."""

    def __init__(self) -> None:
        self.items: list[tuple[str, bool, bool]] = []  # element, in a part that is no text, in an article
        self.named: dict[str, list[int]] = {}
        self.regions: list[int] = []
        self.blocks: list[int] = []

    def push(self, name: str, out: bool, inside: bool) -> None:
        at = len(self.items)
        self.items.append((name, out, inside))
        self.named.setdefault(name, []).append(at)
        if name in REGIONS:
            self.regions.append(at)
        if name not in INLINE:
            self.blocks.append(at)

    def cut(self, at: int) -> None:
        while len(self.items) > at:
            name = self.items.pop()[0]
            self.named[name].pop()
            if name in REGIONS:
                self.regions.pop()
            if name not in INLINE:
                self.blocks.pop()

    def last(self, name: str) -> int:
        places = self.named.get(name)
        return places[-1] if places else -1


def parse(source: str) -> Page:
    """The page's blocks in order, each with its kind and its place."""
    page, parts, opened = Page(), [], _Open()
    at, last = 0, source.rfind(">")

    def close() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                _, out, inside = opened.items[-1] if opened.items else ("", False, False)
                page.texts.append(text)
                page.kinds.append(PART if out else TEXT if inside else OPEN)
                page.places.append("/".join(s[0] for s in opened.items[-3:]))

    while True:
        m = TAG.search(source, at) if at <= last else None
        if m is None:
            parts.append(source[at:])
            close()
            return page
        if m.start() > at:
            parts.append(source[at : m.start()])
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            k, region = opened.last(name), opened.regions[-1] if opened.regions else -1
            if k < 0 or (name not in REGIONS and k < region):
                if name not in INLINE and (name in REGIONS or region < 0):
                    close()  # an end tag of nothing still ends a block
            elif name not in INLINE:
                close()
                opened.cut(k)
            elif not opened.blocks or opened.blocks[-1] < k:  # a line's element does not end blocks
                opened.cut(k)
            continue
        if name in RAW:
            if name != "head":
                end = re.compile(rf"</{name}\s*>", re.I).search(source, at)
                at = end.end() if end else len(source)
            else:
                end = re.compile(r"</head\s*>|<body[\s>]", re.I).search(source, at)
                at = len(source) if not end else end.end() if end[0].startswith("</") else end.start()
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE:
            close()
        if name in VOID or m[3].endswith("/"):
            continue
        if name == "p" and opened.blocks and opened.items[opened.blocks[-1]][0] == "p":
            opened.cut(opened.blocks[-1])
        _, out, inside = opened.items[-1] if opened.items else ("", False, False)
        opened.push(name, out or _no_text(name, m[3], inside), inside or name in ("article", "main"))


def _names_part(value: str, wanted: frozenset[str]) -> bool:
    """Whether a class or id says, as a whole name, that it is one of the wanted parts."""
    for token in value.split():
        words = [w for w in re.split(r"[-_]+|(?<=[a-z])(?=[A-Z])", token) if w and not w.isdigit()]
        low = [w.lower() for w in words]
        if any(w in wanted for w in low) and all(w in wanted or w in STRONG or w in WEAK or w in HEADERS or w in BESIDE for w in low):
            return True
    return False


def _no_text(name: str, attributes: str, inside: bool) -> bool:
    if name in NOT_TEXT or (name == "header" and not inside):
        return True
    if not attributes or name in ("html", "body"):
        return False
    wanted = STRONG if name == "section" else STRONG | WEAK if inside else STRONG | WEAK | HEADERS
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "role" and value.lower() in ROLES or key == "hidden":
            return True
        if key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if key in ("class", "id") and name not in ("article", "main") and _names_part(value, wanted):
            return True
    return False


def stream(page: Page) -> tuple[list[int], list[int]]:
    """Hashed tokens of all blocks outside articles, a page's end after them, and the block of each token; -1 for the end."""
    tokens, owner = [], []
    for i, (text, kind, place) in enumerate(zip(page.texts, page.kinds, page.places)):
        if kind != TEXT:
            words = ["\0" + place, *text.lower().split()]
            tokens += [xxhash.xxh64_intdigest(w.encode("utf-8", "replace")) >> 1 for w in words]
            owner += [i] * len(words)
    return [*tokens, END], [*owner, -1]


def article_stream(body: str, known: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """What stream gives, for the blocks of an article's text. known remembers words."""
    words, sizes = [], []
    for text in body.split("\n\n"):
        own = text.lower().split()
        words += ["\0", *own]
        sizes.append(len(own) + 1)
    if len(known) > KNOWN:
        known.clear()
    found = list(map(known.get, words))
    if None in found:
        for w in {w for w, n in zip(words, found) if n is None}:
            known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "replace")) >> 1
        found = list(map(known.get, words))
    return np.array([*found, END], np.int64), np.r_[np.repeat(np.arange(len(sizes)), sizes), -1]


#: Words that a worker remembers at most between two articles.
KNOWN = 100_000
#: The token of a page's end.
END = xxhash.xxh64_intdigest(b"\0") >> 1


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower() if m else ""


def parsed(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) as (key, page_id, url, host, body, blocks, kinds, tokens, owner, content).

    body is the text of a settled page, else null; blocks are kept of the others alone. content is the hash of the page.
    """
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for whole in batches:
            for i, j in slices(utf8(whole.column(2))):
                b = whole.slice(i, j - i)
                hosts, bodies, blocks, kinds, tokens, owners, contents = [], [], [], [], [], [], []
                for url, source in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                    page = parse(source or "")
                    t, o = stream(page)
                    settled = page.settled
                    hosts.append(host_of(url))
                    bodies.append("\n\n".join(x for x, k in zip(page.texts, page.kinds) if k == TEXT) if settled else None)
                    blocks.append([] if settled else page.texts)
                    kinds.append([] if settled else page.kinds)
                    tokens.append(t)
                    owners.append([] if settled else o)
                    contents.append(xxhash.xxh64_intdigest((source or "").encode("utf-8", "surrogatepass")) >> 1)
                keys = pa.array((part << 40) + n + np.arange(b.num_rows))
                n += b.num_rows
                cols = [keys, b.column(0), b.column(1), pa.array(hosts, pa.string()), pa.array(bodies, pa.string()), pa.array(blocks, pa.list_(pa.string()))]
                cols += [pa.array(kinds, pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int64())), pa.array(owners, pa.list_(pa.int32())), pa.array(contents, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["key", "page_id", "url", "host", "body", "blocks", "kinds", "tokens", "owner", "content"])

    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(released(run), f"key long, page_id {kind}, url string, host string, body string, blocks array<string>, kinds array<int>, tokens array<long>, owner array<int>, content long")


def suffix_array(streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the concatenated streams: the suffixes in order, the common prefix of each with the one before it, the page of each token, all tokens.

    Suffixes are sorted by doubling; a common prefix never leaves its page. Its length comes from the ranks of each doubling, the longest first.
    A rank is the place of the first suffix that shares it, so that only shared ones are worked on again.
    """
    sizes = np.array([len(x) for x in streams], np.int64)
    x = np.concatenate(streams) if len(streams) else np.zeros(0, np.int64)
    page = np.repeat(np.arange(len(sizes)), sizes)
    room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(x))  # tokens to the page's end
    _, code, n = np.unique(x, return_inverse=True, return_counts=True)
    rank, open_ = (np.cumsum(n) - n)[code], np.flatnonzero(n[code] > 1)
    spans, ranks, span = [1], [rank], 1
    while span < (sizes.max() if len(sizes) else 0) and len(open_):
        inner = room[open_] > span
        follow = -2 - page[open_]  # past its end no two pages are alike
        follow[inner] = rank[open_[inner] + span]
        own, low = rank[open_], follow.min()
        key = own * (follow.max() - low + 1) + (follow - low)
        at = np.argsort(key, kind="stable")
        key, own = key[at], own[at]
        first = np.r_[True, key[1:] != key[:-1]]  # of those that stay together
        head = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        since = np.arange(len(at)) - np.repeat(head, np.diff(np.r_[head, len(at)]))
        group = np.cumsum(first) - 1
        rank = rank.copy()
        rank[open_[at]] = own + since[first][group]
        open_ = open_[at[np.bincount(group)[group] > 1]]
        span *= 2
        spans.append(span)
        ranks.append(rank)
    order = np.argsort(rank, kind="stable")
    common = np.zeros(len(x), np.int64)
    if len(x) > 1:
        a, b = order[:-1], order[1:]
        n = np.zeros(len(a), np.int64)
        for span, rank in zip(reversed(spans), reversed(ranks)):
            fits = np.flatnonzero((room[a] - n >= span) & (room[b] - n >= span))
            same = fits[rank[a[fits] + n[fits]] == rank[b[fits] + n[fits]]]
            n[same] += span
        common[1:] = n
    return order, common, page, x


def repeats(streams: list[np.ndarray], length: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The places, in the concatenated streams, of one occurrence of each substring of `length` tokens, and the pages that it stands on, if `least` or more."""
    order, common, page, x = suffix_array(streams)
    if not len(x):
        return order, order
    starts = np.flatnonzero(common < length)  # suffixes that agree in `length` tokens are neighbours
    group = np.cumsum(common < length) - 1
    pair = np.unique(group * (len(streams) + 1) + page[order])
    pages = np.bincount(pair // (len(streams) + 1), minlength=len(starts))
    end = np.repeat(np.cumsum([len(s) for s in streams]), [len(s) for s in streams])
    first = order[starts]
    kept = (pages >= least) & (first + length <= end[first])
    return first[kept], pages[kept]


def names_of(tokens: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The names, hashes, of the substrings that begin at `at`."""
    name = np.zeros(len(at), np.uint64)
    for k in range(length):
        name = name * np.uint64(0x9E3779B97F4A7C15) + tokens[at + k].astype(np.uint64)
        name = (name ^ (name >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        name ^= name >> np.uint64(29)
    return name.view(np.int64)


def share_of(pages: int, p: Params) -> int:
    """The share of these pages, rounded up."""
    return -(-int(pages * p.share * 1000) // 1000)


def enough(pages: int, p: Params) -> int:
    """How many of a host's distinct pages a substring must stand on."""
    return max(p.pages, share_of(pages, p))


#: Parts in which a host's pages meet its boilerplate.
SALT = 32


def streams_of(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """The streams of each row of a column of tokens, of articles' texts or of packed ones."""
    known: dict[str, int] = {}
    for x in column:
        if isinstance(x, pa.ListScalar):
            yield [x.values.to_numpy()]
        elif isinstance(x, pa.BinaryScalar) and not isinstance(x, pa.StringScalar):
            whole = x.as_py()
            texts = pa.decompress(whole[8:], int.from_bytes(whole[:8], "little"), codec="zstd", asbytes=True)
            yield [article_stream(t, known)[0] for t in texts.decode("utf-8", "surrogatepass").split(BETWEEN)]
        else:
            yield [article_stream(x.as_py(), known)[0]]


#: What stands between packed articles: white space, which blocks hold none of but blanks.
BETWEEN = "\x1e"
#: Characters of articles that are packed together, about.
PACK = 1 << 20


def packed(rows: DataFrame) -> DataFrame:
    """rows(host, at, pages, pieces, told) with the articles that come together compressed as one: less is moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: dict[tuple, list[str]] = {}
            sizes: dict[tuple, int] = {}
            spots, told = [], []

            def out(spot: tuple) -> None:
                whole = BETWEEN.join(held.pop(spot)).encode("utf-8", "surrogatepass")
                spots.append(spot)
                told.append(len(whole).to_bytes(8, "little") + pa.compress(whole, codec="zstd", asbytes=True))

            for *spot, text in zip(*(b.column(k).to_pylist() for k in range(5))):
                spot = tuple(spot)
                held.setdefault(spot, []).append(text)
                sizes[spot] = sizes.get(spot, 0) + len(text)
                if sizes[spot] >= PACK:
                    out(spot)
                    sizes[spot] = 0
            for spot in list(held):
                out(spot)
            cols = [pa.array([x[k] for x in spots], b.column(k).type) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(told, pa.binary())], ["host", "at", "pages", "pieces", "told"])

    return rows.mapInArrow(released(run), "host string, at int, pages long, pieces int, told binary")


def boilerplate(rows: DataFrame, p: Params) -> DataFrame:
    """(host, names): the names of each host's repeated substrings of `length` tokens, from rows(key, host, content, size, told).

    told holds the tokens or an article's text; size is the most tokens that it may be.
    """
    keys = stored(rows.select("key", "host", "content", "size"), "html-keys")
    distinct = stored(keys.groupBy("host", "content").agg(F.min("key").alias("key"), F.max("size").alias("size"), F.count(F.lit(1)).alias("n")), "html-distinct")
    hosts = distinct.groupBy("host").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("pages"))
    hosts = stored(hosts.filter(F.col("pages") >= p.pages).withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("size") / p.piece)).cast("int")), "html-hosts")
    # copies are less than what stays, so that is what is joined
    copied = distinct.filter("n > 1").select("host", "content", F.col("key").alias("first"))
    copies = stored(keys.join(copied, ["host", "content"]).filter("key <> first").select("key"), "html-copies")
    one = rows.join(copies, "key", "left_anti").select("key", "host", "told")
    placed = one.join(hosts, "host").withColumn("at", F.pmod(F.xxhash64("key"), F.col("pieces")).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, where = [], None

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                host, _, pages, pieces = where
                # what is on a share of all pages is on that share of the pages of one piece at least
                at, _ = repeats(held, p.length, enough(pages, p) if pieces == 1 else max(1, share_of(len(held), p)))
                name = names_of(np.concatenate(held), at, p.length)
                for k in range(0, len(name), 100_000):
                    m = len(name[k : k + 100_000])
                    cols = [pa.array([host] * m, pa.string()), pa.array([pages] * m, pa.int64()), pa.array([pieces] * m, pa.int32()), pa.array(name[k : k + m])]
                    yield pa.RecordBatch.from_arrays(cols, ["host", "pages", "pieces", "name"])

        for b in batches:
            for spot, streams in zip(zip(*(b.column(k).to_pylist() for k in range(4))), streams_of(b.column(4))):
                if spot != where:
                    yield from out()
                    held, where = [], spot
                held += streams
        yield from out()

    placed = placed.select("host", "at", "pages", "pieces", "told")
    if placed.schema["told"].dataType.simpleString() == "string":
        placed = packed(placed)
    dealt = placed.repartition("host", "at").sortWithinPartitions("host", "at")
    found = stored(dealt.mapInArrow(released(run), "host string, pages long, pieces int, name long").distinct(), "html-found")
    told = found.filter("pieces = 1").select("host", "name")
    split = found.filter("pieces > 1")
    if split.limit(1).count():
        told = told.union(_counted(one, split, p))
    return told.groupBy("host").agg(F.collect_list("name").alias("names"))  # each on a share of the pages, so they are few


def _counted(pages: DataFrame, found: DataFrame, p: Params) -> DataFrame:
    """(host, name): those of found(host, pages, name) that stand on enough of all pages(key, host, told)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, names = [], []
            for host, (own,), wanted in zip(b.column(0).to_pylist(), streams_of(b.column(1)), b.column(2)):
                here = np.unique(names_of(own, np.arange(max(0, len(own) - p.length + 1)), p.length))
                here = here[np.isin(here, wanted.values.to_numpy())]
                hosts += [host] * len(here)
                names.append(here)
            flat = np.concatenate(names) if names else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(flat, pa.int64())], ["host", "name"])

    lists = found.groupBy("host").agg(F.collect_list("name").alias("names"), F.first("pages").alias("pages"))
    met = _met(pages, stored(lists.select("host", "names"), "html-wanted"), "inner")
    counts = met.select("host", "told", "names").mapInArrow(released(run), "host string, name long").groupBy("host", "name").agg(F.count(F.lit(1)).alias("n"))
    least = F.greatest(F.lit(p.pages), F.ceil(F.floor(F.col("pages") * p.share * 1000) / 1000))
    return counts.join(lists.select("host", "pages"), "host").filter(F.col("n") >= least).select("host", "name")


def _met(rows: DataFrame, names: DataFrame, how: str) -> DataFrame:
    """rows(key, host, ...) with the names of their host; a hot host's rows meet them in SALT parts."""
    salted = names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return rows.withColumn("salt", F.pmod("key", F.lit(SALT)).cast("int")).join(salted, ["host", "salt"], how)


def covered(tokens: np.ndarray, names: np.ndarray, length: int) -> np.ndarray:
    """Whether a substring of these names covers each token."""
    if not len(names) or len(tokens) < length:
        return np.zeros(len(tokens), bool)
    at = np.arange(len(tokens) - length + 1)
    hit = at[np.isin(names_of(tokens, at, length), names)]
    edge = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + length, -1)
    return np.cumsum(edge[:-1]) > 0


def cut_article(body: str, names: np.ndarray, length: int, known: dict[str, int]) -> str:
    """The article's text without the blocks that substrings of these names cover whole, unless those are more than half of it."""
    tokens, owner = article_stream(body, known)
    gone, texts = covered(tokens, names, length), body.split("\n\n")
    left = np.unique(owner[~gone & (owner >= 0)])
    words = np.bincount(owner[owner >= 0], minlength=len(texts)) - 1  # without the mark
    if len(left) == len(texts) or 2 * words[left].sum() < words.sum():
        return body
    return "\n\n".join(texts[i] for i in left)


def cut(texts: list[str], kinds: list[int], tokens: np.ndarray, owner: np.ndarray, names: np.ndarray, length: int) -> str:
    """The page's text: what no substring of these names covers, of the blocks that markup leaves open."""
    gone = covered(tokens, names, length)
    out = []
    for i, (text, kind) in enumerate(zip(texts, kinds)):
        if kind == OPEN:
            own = gone[owner == i]  # the first is the place's token
            if own.all():
                continue
            # what only reaches over from the next block is too short to tell
            edges = np.flatnonzero(np.diff(np.r_[False, own, False]))
            long = [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= length]
            if long:
                words = ["", *text.split()]
                for a, b in long:
                    words[a:b] = [""] * (b - a)
                text = " ".join(w for w in words if w)
            if text:
                out.append(text)
    return "\n\n".join(out)


def extract(pages: DataFrame, p: Params = Params(), inner: Params = ARTICLES) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages(page_id, url, html); p tells what repeats outside of articles, inner inside."""
    rows = stored(parsed(pages), "html-blocks")
    kind = rows.schema["page_id"].dataType.simpleString()
    made = f"page_id {kind}, url string, text string"
    loose = rows.filter("body IS NULL")
    whole = rows.filter("body IS NOT NULL")
    # an article's content is its text; a token takes two characters or more
    articles = whole.filter("body <> ''").select("key", "host", F.xxhash64("body").alias("content"), (F.length("body") / 2 + 2).cast("int").alias("size"), F.col("body").alias("told"))
    within = stored(boilerplate(articles, inner), "html-template")
    if within.limit(1).count():

        def run_articles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: dict[str, int] = {}
            for b in batches:
                texts = [cut_article(x, np.array(n, np.int64), inner.length, known) if x and n else x for x, n in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

        out = _met(whole, within, "left").select("page_id", "url", "body", "names").mapInArrow(released(run_articles), made)
    else:
        out = whole.select("page_id", "url", F.col("body").alias("text"))
    hosts = stored(loose.select("host").distinct(), "html-open")
    if hosts.limit(1).count():
        found = boilerplate(rows.join(hosts, "host", "left_semi").withColumn("size", F.size("tokens")).withColumnRenamed("tokens", "told"), p)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                texts_made = []
                for texts, kinds, tokens, owner, names in zip(*(b.column(k) for k in range(2, 7))):
                    numbers = [np.array(x.as_py() or [], np.int64) for x in (tokens, owner, names)]
                    texts_made.append(cut(texts.as_py(), kinds.as_py(), *numbers, p.length))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts_made, pa.string())], ["page_id", "url", "text"])

        texts = _met(loose, found, "left").select("page_id", "url", "blocks", "kinds", "tokens", "owner", "names").mapInArrow(released(run), made)
        out = out.union(texts)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
