"""Secrets in texts: fixed forms, and strings that zstandard cannot predict from what surrounds them.

The fixed forms are assignments to a sensitive name, access key ids and long hexadecimal runs. Beyond them, every string in a
sensitive context is a candidate, runs that go on over dots and line ends as a whole: the bytes it adds to the compressed surrounding text, with a dictionary of
common identifiers and the document's own ones loaded beforehand, are measured; what stays nearly incompressible is
reported, what repeats the code around it or is made of identifiers is not.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .batches import tidy

KINDS = ("assign", "access", "hex", "novel")

# The forms that are always reported.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

_C = "[A-Za-z0-9+/_=-]"
# Pieces joined by dots; a piece of 40 or more at a line end goes on in the next line, if that has nothing else.
_RUN = re.compile(rf"{_C}+(?:\.{_C}+)*(?:(?<={_C}{{40}})(?:\\n(?!-----){_C}+|[\x20\t]*\r?\n[\x20\t]*(?!-----){_C}+(?=[\x20\t]*(?:\r?\n|\Z))))*")
_LONG = re.compile(rf"{_C}{{40,}}")
# What white space and quotes delimit; in a URL, its parts.
_TOKEN = re.compile(r"""[^\s"'`<>]+""")
_URL_PART = re.compile(r"[^/?&=#.:@%]+")
# URLs, mail addresses and dotted numbers.
_ADDRESS = re.compile(r".*://.*|[(\[{]*[\w.+-]+@\w[\w-]*\.\w.*|\W*\d+(?:\.\d+){2,}\W*", re.S)
_WORDS = "key|secret|token|passw|passphrase|passcode|pwd|auth|credential|private|bearer|signature|cert|session|cookie"
_SENSITIVE = re.compile(_WORDS, re.I | re.A)
_VALUE = re.compile(rf"""(?:{_WORDS})[A-Za-z0-9_-]{{0,20}}["']?[\x20\t]*[:=][\x20\t]*["']?([^\s"'`<>]+)""", re.I | re.A)
_BEGIN = re.compile(r"-----BEGIN ([^\n-]{1,60})-----")
_HEXADECIMAL = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SIGNS = re.compile(r"[\W_]+")
_RUNS_OF_LETTERS = re.compile(r"[^\W\d_]+")
_VOWELS = frozenset("aeiouy")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,}")

# Identifiers that are common in source code; a string made of them is no news.
IDENTIFIERS = (
    "abstract access account action address admin api app application argument array assert async attribute auth await base "
    "bearer body boolean branch bucket buffer build bytes cache callback certificate class client cloud code column command "
    "commit config connection const constant content context cookie count create credential data database date debug default "
    "delete description device dict digest directory document domain element email enabled encode endpoint enum environment "
    "error event example exception expire export extends false file final float folder format from function generate get group "
    "handler hash header hidden host html http https identifier image implements import index input instance integer interface "
    "item iterator json key label lambda language length level library limit list load local log login main manager master "
    "message method mode model module name namespace node null number object option order output override package page parameter "
    "parent parse password path pattern payload permission place port prefix private project property protected protocol public "
    "query queue random read record redirect region register release remote request resource response result return role root "
    "schema scheme scope script secret select self server service session setting signature size source static status storage "
    "stream string struct super switch system table target template test text thread time timestamp title token true type "
    "update upload user username util value variable vector version view void while window worker write"
).split()


@dataclass(frozen=True)
class NoveltyParameters:
    """A candidate is news if it adds ``least_share`` of its length and ``least_bytes`` to the compressed text around it, or
    ``least_assigned`` if it is assigned to a sensitive name; digits and hexadecimals, which compress by themselves, that
    share of the room they need (``room``). ``window``
    characters on either side are the surroundings. ``context`` before it (half of that for digits alone) and ``after`` behind it
    must hold a sensitive word or, before it, the end of a reported string, or BEGIN and END enclose it."""
    least_share: float = 0.62
    least_bytes: int = 12
    least_assigned: int = 8
    window: int = 1_000
    context: int = 96
    after: int = 8


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms, in code points."""
    out = []
    folded = text.lower()
    if any(name in folded for name in _NAMES):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def primed(identifiers: bytes) -> zstandard.ZstdCompressor:
    """A compressor that knows the identifiers. The dictionary is digested once, so a candidate costs its surroundings only."""
    known = zstandard.ZstdCompressionDict(identifiers, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(level=3)
    return zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False, dict_data=known)


def marginal_bytes(compressor: zstandard.ZstdCompressor, candidate: str, before: str, after: str) -> int:
    """Bytes that the candidate adds to the compressed surroundings."""
    around = (after + "\n" + before).encode()
    return len(compressor.compress(around + candidate.encode())) - len(compressor.compress(around))


def room(word: str) -> float:
    """Share of its length that a string of random characters of its kind takes when compressed: entropies of 10 and 16 signs
    against those of 64, and some more for digits, which get codes of whole bits."""
    return 0.55 if word.isdigit() else 4 / 6 if _HEXADECIMAL.fullmatch(word) else 1.0


def _delimited(text: str) -> list[tuple[int, int, bool]]:
    """Spans between white space and quotes, without the punctuation around them. Addresses are left out."""
    out = []
    for m in _TOKEN.finditer(text):
        a, word = m.start(), m.group()
        if not _ADDRESS.fullmatch(word):
            out.append((a + len(word) - len(word.lstrip("([{")), a + len(word.rstrip(",;.:)]}!?")), False))
    return out


def _candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, bool, bool]]:
    """(start, end, whether assigned or next to a fixed form, whether enclosed) of the strings outside the fixed forms."""
    spans = _delimited(text)
    urls = [m.span() for m in _TOKEN.finditer(text) if _ADDRESS.fullmatch(m.group())]
    for m in _RUN.finditer(text):  # inside an address only its parts are candidates
        k = bisect.bisect_right(urls, (m.start(), len(text))) - 1
        if k >= 0 and m.start() < urls[k][1]:
            spans += [(x.start(), x.end(), False) for x in _URL_PART.finditer(text, m.start(), min(m.end(), urls[k][1]))]
            if m.end() > urls[k][1]:
                spans.append((urls[k][1], m.end(), False))
        else:
            spans.append((m.start(), m.end(), False))
    for m in _VALUE.finditer(text):
        spans.append((m.start(1), m.start(1) + len(m.group(1).rstrip(",;.:)]}")), True))
    blocks = []
    ends = [m.start() for m in re.finditer("-----END", text)]
    for m in _BEGIN.finditer(text):
        if _SENSITIVE.search(m.group(1)):
            k = bisect.bisect_left(ends, m.end())
            blocks.append((m.end(), ends[k] if k < len(ends) else len(text)))
    merged: list[list] = []
    for a, b, own in sorted(spans):
        if merged and a < merged[-1][1]:
            merged[-1][1:] = max(b, merged[-1][1]), own or merged[-1][2]
        elif a < b:
            merged.append([a, b, own])
    out, k, at = [], 0, 0
    fixed = sorted((x, y) for x, _, y in base)
    reach = 0  # fixed forms may overlap: the farthest end so far
    for a, b, own in merged:
        while at < len(blocks) and blocks[at][1] <= a:
            at += 1
        enclosed = at < len(blocks) and blocks[at][0] <= a
        start = max(a, min(reach, b))
        while k < len(fixed) and fixed[k][0] < b:
            if fixed[k][1] > start:
                if fixed[k][0] > start:
                    out.append((start, fixed[k][0], True, enclosed))
                start = min(b, fixed[k][1])
            reach = max(reach, fixed[k][1])
            k += 1
        if start < b:
            out.append((start, b, own or start > a, enclosed))
    return out


def _identifier(word: str) -> bool:
    """Whether a word without digits is made of words, not of letters at random: its parts by case are not tiny, not endless, and
    four fifths of its letters are in parts with a vowel."""
    parts = _PARTS.findall(word)
    size = sum(map(len, parts))
    return len(word) < 10 or bool(parts) and size >= 2.6 * len(parts) and len(max(parts, key=len)) <= 24 and sum(
        len(x) for x in parts if not _VOWELS.isdisjoint(x.lower())) >= 0.8 * size


def novel_spans(text: str, base: list[tuple[int, int, int]], p: NoveltyParameters = NoveltyParameters()) -> list[tuple[int, int, int]]:
    """Incompressible strings in a sensitive context that no fixed form covers."""
    found, compressor = [], None
    if not base and not _SENSITIVE.search(text):
        return found
    for a, b, own, enclosed in _candidates(text, base):
        if b - a < (p.least_assigned if own else p.least_bytes) / 2:  # a byte for two characters at the very least
            continue
        word = "".join(text[a:b].split())
        signs = _SIGNS.sub("", word)
        reach = p.context // 2 if signs.isdigit() else p.context  # numbers of all kinds are common
        near = own or enclosed or found and a - found[-1][2] <= reach
        if not near and not _SENSITIVE.search(text[max(0, a - reach):a] + " " + text[b:b + p.after]):
            continue
        if all(map(_identifier, _RUNS_OF_LETTERS.findall(word))) and not any(map(str.isdigit, word)):
            continue  # words and punctuation
        if compressor is None:
            words = dict.fromkeys(w for w in _IDENTIFIER.findall(_LONG.sub(" ", text))
                                  if len(w) <= 40 and not any(c.isdigit() for c in w) and _identifier(w))
            compressor = primed(" ".join([*IDENTIFIERS, *words]).encode())
        size, share = len(word.encode()), room(signs)
        adds = marginal_bytes(compressor, word, text[max(0, a - p.window):a], text[b:b + p.window])
        if adds >= p.least_share * share * size and adds >= share * (p.least_assigned if own else p.least_bytes):
            found.append((a, 3, b))
    return found


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def secrets(docs: DataFrame, p: NoveltyParameters = NoveltyParameters()) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans`` per row of ``docs``.

    Spans are kind:start:end of whole matches in code points, end exclusive, by start, then kind. NULL counts as the empty text,
    which has none; a NULL ``doc_id`` passes through; repeated rows get equal rows; an empty table gives none.
    """
    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                novel = novel_spans(text, base, p) if text else []
                kinds = [k for _, k, _ in base]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2), len(novel),
                             hashlib.sha256(_written(base).encode()).hexdigest(), _written(sorted(base + novel))))
            columns = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(tidy(run), "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")
