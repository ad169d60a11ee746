"""Plain versions of the contracts, for small tables."""

import base64
import hashlib
import re
import uuid
from collections import defaultdict
from html.parser import HTMLParser

import numpy as np
import xxhash
import zstandard

# Names that the operators use inside; as extra columns of an input they must not matter.
CLASHES = ["id", "key", "raw", "owner", "n", "fp", "size", "score", "taken", "n_lines", "n_dropped", "text_key", "blob", "rank",
           "host", "path", "item", "unit", "range", "copies", "record", "n_bytes", "n_tokens", "component", "kept",
           "_id", "_key", "_text_key", "_n", "_runs", "_lines", "_dropped", "_raw", "_source", "_item_key", "target", "source_size",
           "row", "text_id", "kept_id", "kept_key", "leaking_id", "mix_id", "nth", "of", "all", "gone", "runs", "bm25", "overlap",
           "question_overlap", "fingerprint", "component_id", "extra", "more", "quota", "here", "before", "lines", "pos", "h1", "h2"]
BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def drop_lines(rows, min_chars=40, min_docs=5):
    """[(id, n_lines, n_dropped, kept text)] for [(id, text)]."""
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    holders = defaultdict(set)
    for id_, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(id_)
    owner = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for id_, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in owner or owner[key(x)] == id_]
        out.append((id_, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def simhash(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=2):
    """Smallest id reachable for [(id, fingerprint)], by comparing all pairs."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= radius:
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (id_, _) in enumerate(prints):
        ids[root(i)].append(id_)
    return [min((x for x in ids[root(i)] if x is not None), default=None) for i in range(len(prints))]


def secrets(text):
    """(kind, start, end) by the contract's own patterns."""
    found = []
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for m in assign.finditer(text):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 18:
            found.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 16:
            found.append((m.start(), 2, "hex", m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def judge(url, rules, default="allow"):
    """(host, path, rule, verdict)."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.translate(LOWER)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def targets(sizes, weights=(5, 2, 1), most=3):
    """{source: target} for {source: size}; sources by code point, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, goal, capped = sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        goal = {s: most * sizes[s] if s in capped else rest * weight[s] / free for s in order}
        above = {s for s in order if s not in capped and goal[s] > most * sizes[s]}
        if not above:
            return goal
        capped |= above


def best_mix(sizes, target, most=3):
    """Words of whole copies of all documents and of the best subset, not above the target."""
    size, budget = sum(sizes), int(target + 0.5)
    if not size:
        return 0
    copies, reach = min(budget // size, most), 1
    rest = budget - copies * size if copies < most else 0
    for s in sizes:
        reach |= reach << s
    return copies * size + (reach & ((1 << rest + 1) - 1)).bit_length() - 1


def word_count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def contains_item(text, item):
    norm = lambda s: " " + " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", s.translate(LOWER))) + " "
    return norm(item) in norm(text or "")


def rows_of(df, *columns):
    """Rows as sorted tuples, nulls first."""
    return sorted(map(tuple, df.select(*columns).collect()), key=lambda r: tuple((x is not None, x) for x in r))


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def compressed_size(dictionary, text):
    """Bytes of a text cut into blocks of 512 bytes, each a frame of its own under the dictionary; each must unpack again."""
    shared, size = zstandard.ZstdCompressionDict(dictionary), 0
    shared.precompute_compress(level=3)
    for start in range(0, len(text), 512):
        block = text[start:start + 512]
        frame = zstandard.ZstdCompressor(dict_data=shared, write_content_size=False, write_dict_id=False).compress(block)
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        assert unpack.decompress(frame, max_output_size=512) == block
        size += len(frame)
    return size


def quality_score(model, text):
    """The size saved by the good dictionary per byte, drawn to the mean as if 200 average bytes came along, on the curve."""
    raw = (text or "").encode()
    saved = compressed_size(model.bad, raw) - compressed_size(model.good, raw)
    at = model.slope * (saved + 200 * model.mean) / (len(raw) + 200) + model.offset
    return float(1 / (1 + np.exp(-at)))


class PageText(HTMLParser):
    """Visible text of a well-formed page by the standard library's HTML reader."""

    # Elements that end a line, and those that are not shown.
    BLOCKS = """p div br hr h1 h2 h3 h4 h5 h6 li ul ol tr table td th section article header footer nav main aside blockquote pre form
    title figure figcaption dl dt dd body html head""".split()
    HIDDEN = ("script", "style", "noscript", "template", "svg")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in self.HIDDEN
        self.out.append(" " if tag in self.HIDDEN else "\n" if tag in self.BLOCKS else "")

    def handle_endtag(self, tag):
        self.hidden -= tag in self.HIDDEN
        self.out.append("\n" if tag in self.BLOCKS else "")

    def handle_comment(self, data):
        self.out.append(" ")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data.replace("\n", " "))


def page_text(page):
    reader = PageText()
    reader.feed(page)
    reader.close()
    lines = [re.sub("[ \t\r\f\v]+", " ", line).strip(" ") for line in "".join(reader.out).split("\n")]
    return "\n".join(line for line in lines if line).strip()


def warc_records(url, page):
    """type -> (id, refers to, whole record) of one page, written out field by field."""
    space = uuid.uuid5(uuid.NAMESPACE_URL, "urn:kandela:warc")
    name = lambda *parts: f"<urn:uuid:{uuid.uuid5(space, ' '.join(parts))}>"
    sha1 = lambda data: "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
    date, payload, text = "1970-01-01T00:00:00Z", page.encode(), page_text(page).encode()
    response = name("response", url, date, sha1(payload))
    conversion = name("conversion", response, sha1(text))
    fields = (f"source-record: {response}\r\nsource-payload-digest: {sha1(payload)}\r\nsource-payload-length: {len(payload)}\r\n"
              "source-content-type: text/html; charset=utf-8\r\nsource-header-content-type: text/html; charset=utf-8\r\n"
              f"conversion-record: {conversion}\r\nconversion-payload-digest: {sha1(text)}\r\nconversion-length: {len(text)}\r\n").encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    found = {}
    for kind, own, refers, mime, block, inner in (
            ("response", response, None, "application/http; msgtype=response", http, payload),
            ("metadata", name("metadata", response, sha1(fields)), response, "application/warc-fields", fields, fields),
            ("conversion", conversion, response, "text/plain; charset=utf-8", text, text)):
        head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {own}\r\nWARC-Date: {date}\r\nWARC-Target-URI: {url}\r\n"
        head += f"WARC-Refers-To: {refers}\r\n" if refers else ""
        head += f"WARC-Block-Digest: {sha1(block)}\r\nWARC-Payload-Digest: {sha1(inner)}\r\nContent-Type: {mime}\r\n"
        found[kind] = own, refers, head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    return found
