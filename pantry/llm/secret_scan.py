"""Secret scans: an Aho-Corasick automaton finds keywords in one pass over a text,
regular expressions run anchored at the hits alone, and secrets that carry a
checksum are reported only if it holds.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

#: Kinds in the order in which spans of one start are listed; the first three have no checksum.
KINDS = ("assign", "access", "hex", "github", "npm", "xprv", "age", "nsec")
BASE = KINDS[:3]
#: A run of hexadecimal digits this long or longer is of kind hex; every piece of HEX_KEY digits of it is a keyword.
HEX_LEAST, HEX_KEY = 24, 4

#: Alphabets of the checksums.
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def crc_holds(token: str) -> bool:
    """The last six characters are the CRC-32 of the thirty after the prefix, in base 62."""
    body, n = token[4:], zlib.crc32(token[4:34].encode())
    digits = ""
    for _ in range(6):
        n, d = divmod(n, 62)
        digits = BASE62[d] + digits
    return body[30:] == digits


def base58_holds(key: str) -> bool:
    """78 bytes, then the first four of their double SHA-256."""
    n = functools.reduce(lambda n, c: n * 58 + BASE58.index(c), key, 0)
    if n.bit_length() > 82 * 8:
        return False
    raw = n.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(raw[:78]).digest()).digest()[:4] == raw[78:]


def bech32_holds(key: str) -> bool:
    """The polynomial checksum of prefix and data is 1; one case throughout."""
    if key not in (key.lower(), key.upper()):
        return False
    prefix, _, data = key.lower().rpartition("1")
    check = 1
    for v in [*(ord(c) >> 5 for c in prefix), 0, *(ord(c) & 31 for c in prefix), *map(BECH32.index, data)]:
        top, check = check >> 25, (check & 0x1FFFFFF) << 5 ^ v
        for i, g in enumerate(BECH32_GENERATOR):
            check ^= g if top >> i & 1 else 0
    return check == 1


def long_value(match: re.Match) -> bool:
    return len(match[2]) >= 6


def longer(n: int) -> Callable[[re.Match], bool]:
    return lambda match: match.end() - match.start() >= n


def checked(holds: Callable[[str], bool]) -> Callable[[re.Match], bool]:
    return lambda match: holds(match[0])


_ANY, _TOKEN = re.ASCII | re.IGNORECASE, "[A-Za-z0-9]{36}(?![A-Za-z0-9])"
#: kind: (keywords in small letters, expression from a keyword's first character on, what a match has to meet).
RULES: dict[str, tuple[list[str], re.Pattern, Callable[[re.Match], bool]]] = {
    "assign": (["password", "passwd", "secret", "token", "apikey", "api_key"], re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _ANY), long_value),
    "access": (["akia"], re.compile(r"AKIA[A-Z0-9]+"), longer(20)),
    "hex": (["".join(x) for x in itertools.product("0123456789abcdef", repeat=HEX_KEY)], re.compile(r"[0-9a-f]+"), longer(HEX_LEAST)),
    "github": (["ghp_", "gho_", "ghu_", "ghs_", "ghr_"], re.compile(rf"gh[pousr]_{_TOKEN}"), checked(crc_holds)),
    "npm": (["npm_"], re.compile(rf"npm_{_TOKEN}"), checked(crc_holds)),
    "xprv": (["xprv"], re.compile(rf"xprv[{BASE58}]{{107}}(?![{BASE58}])"), checked(base58_holds)),
    "age": (["age-secret-key-1"], re.compile(rf"AGE-SECRET-KEY-1[{BECH32.upper()}]{{58}}(?![A-Za-z0-9])"), checked(bech32_holds)),
    "nsec": (["nsec1"], re.compile(rf"nsec1[{BECH32}]{{58}}(?![A-Za-z0-9])"), checked(bech32_holds)),
}


def automaton() -> ahocorasick.Automaton:
    """All keywords; a hit tells its kinds' numbers and the keyword's length."""
    kinds: dict[str, list[int]] = {}
    for i, kind in enumerate(KINDS):
        for keyword in RULES[kind][0]:
            kinds.setdefault(keyword, []).append(i)
    out = ahocorasick.Automaton()
    for keyword, own in kinds.items():
        out.add_word(keyword, (len(keyword), own))
    out.make_automaton()
    return out


def spans(text: str, keywords: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of all secrets, sorted.  Matches of a kind are the
    leftmost ones that don't overlap; what a match has to meet is asked afterwards.

    No keyword of a kind lies inside another one of it, so hits come by start.  A
    run of hexadecimal digits has a keyword at each of its places, so the first hit
    in it is at its start.
    """
    out, after = [], [0] * len(KINDS)
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z alone: places stay
    rules = [RULES[kind][1:] for kind in KINDS]
    for last, (size, kinds) in keywords.iter(low):
        start = last - size + 1
        for kind in kinds:
            if start >= after[kind]:
                pattern, meets = rules[kind]
                match = pattern.match(text, start)
                if match:
                    after[kind] = match.end()
                    if meets(match):
                        out.append((start, kind, match.end()))
    return sorted(out)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each row of ``docs`` (struct ``row``) and its ``spans``: kind, start, end (code
    points, end excluded), checked (a checksum holds), by start, then as KINDS has them.

    Null and empty texts have no spans.  Texts are read whole, however long.  Rows
    are taken one by one, so repeated rows and null ids are rows like others; an
    empty table gives no rows; columns keep their names inside ``row``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": a, "end": b, "checked": k >= len(BASE)} for a, k, b in spans(t.as_py() or "", keywords)]
                     for t in pc.struct_field(batch.column(0), [at])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["row", "spans"])

    bounded_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("checked", pa.bool_())]))
    at = docs.columns.index(text)
    row = docs.select(F.struct("*").alias("row"))
    return row.mapInArrow(run, f"row {row.schema['row'].dataType.simpleString()}, "
                               "spans array<struct<kind:string,start:bigint,end:bigint,checked:boolean>>")


def redacted(scanned: DataFrame, text: str = "text", sign: str = "*") -> DataFrame:
    """``scanned`` with ``redacted``: the text, a ``sign`` for each character of a span."""
    def cover(done, s):
        begin = F.greatest(s["start"], done["at"])
        more = F.concat(done["out"], F.substr(F.col(f"row.{text}"), (done["at"] + 1).cast("int"), (begin - done["at"]).cast("int")),
                        F.repeat(F.lit(sign), (F.greatest(s["end"], begin) - begin).cast("int")))
        return F.struct(more.alias("out"), F.greatest(s["end"], done["at"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    whole = F.aggregate("spans", start, cover, lambda d: F.concat(d["out"], F.substr(F.col(f"row.{text}"), (d["at"] + 1).cast("int"))))
    return scanned.withColumn("redacted", whole)
