"""Replacement of personal data by keyed surrogates of the same type, gender, script and format.

A surrogate is a keyed permutation of its original within the strings of one shape: letters stay letters of their case
and script, vowels vowels, digits digits, punctuation itself; card numbers keep whether their check digit is right,
addresses their range, given names their gender and script. A permutation gives different originals different
surrogates, and the same original the same one wherever and however written, so references stay joined. Surrogates
that hit another original, or are not new, are found by a check over the corpus and drawn anew until none is left.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.common import stored

MOST_DRAWS = 24
#: From this draw on, names and mailboxes get a letter more with each: a short shape may have no free value left.
WIDER = 8

# Given names by script and gender; surrogates come from the same list.
GIVEN_NAMES = {
    ("latin", "f"): "Anna Maria Emma Julia Laura Sophie Clara Elena Lucia Marta Sarah Alice Nora Ines Paula Helen".split(),
    ("latin", "m"): "Peter Thomas Paul Daniel Martin David Lukas Simon Pablo Carlos Henri Louis James Robert John Oscar".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Ирина Наталья Татьяна Светлана".split(),
    ("cyrillic", "m"): "Иван Пётр Алексей Сергей Дмитрий Николай Андрей Михаил".split(),
    ("greek", "f"): "Μαρία Ελένη Σοφία Άννα Κατερίνα Ειρήνη".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Πέτρος".split(),
}
GENDER_OF = {name.lower(): key for key, names in GIVEN_NAMES.items() for name in names}
TITLES = r"(?:Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Señor|Señora|Sr|Sra|Monsieur|Madame|Mme|M\.)\.?"
#: Classes of characters that surrogates keep.
ALPHABETS = [
    "0123456789",
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "аеиоуыэюя",
    "бвгджзйклмнпрстфхцчшщ",
    "αεηιουω",
    "βγδζθκλμνξπρστφχψ",
    "äöü",
    "áéíóú",
]
HEX = "0123456789abcdef"
CLASS_OF = {c: a for a in ALPHABETS for c in a}
#: Endings of surnames that tell the gender and stay.
GENDERED = re.compile(r"(?:ова|ева|ина|ская|ов|ев|ин|ский|ου|ος|ης|ova|eva|skaya|ov|ev|sky)$", re.I)

PRIVATE = [ipaddress.ip_network(n) for n in ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8", "0.0.0.0/8")]

CAPITAL = r"[A-ZÀ-ÖØ-ÞЀ-ЯΑ-ΩΆΈΉΊΌΎΏ][\w'’-]*"
SURNAME = rf"(?:\s+(?:(?:de|la|von|van|der)\s+)*{CAPITAL})"
PATTERNS = {
    "iban": re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "secret": re.compile(r"\b[0-9a-fA-F]{32,128}\b|(?i:(?<=token = \")|(?<=token=)|(?<=api_key=)|(?<=password=)|(?<=secret=))[^\s\"']{6,}"),
    "ip": re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)"),
    "ssn": re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    "card": re.compile(r"(?<!\d)(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{13,19})(?!\d)"),
    "phone": re.compile(r"(?<![\w.])(?:\+\d{1,3}[^\w\n]{1,5}\d{1,4}|\+\d{1,3}[^\w\n]{0,5}\(\d{1,4}\)|\(\d{2,4}\)|\d{3})(?:[^\w\n]{1,5}\d{2,4}){2,4}(?!\w)"),
}
EMAIL_LOCAL, EMAIL_DOMAIN = re.compile(r"[\w.+%-]+$"), re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
NAME = re.compile(rf"\b{CAPITAL}")
TITLED = re.compile(rf"\b{TITLES}\s+(?={CAPITAL})")
FOLLOWING = re.compile(SURNAME)


def _luhn(digits: str) -> int:
    """The check digit of a number without it."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def find(text: str) -> list[tuple[int, int, str]]:
    """``(begin, end, type)`` of the entities in a text, in order and without overlaps; earlier types take precedence."""
    spans: list[tuple[int, int, str]] = []
    at = text.find("@")
    while at >= 0:
        local, domain = EMAIL_LOCAL.search(text, max(0, at - 64), at), EMAIL_DOMAIN.match(text, at + 1, at + 256)
        if local and domain:
            spans.append((local.start(), domain.end(), "email"))
        at = text.find("@", at + 1)
    if re.search(r"\d", text):
        for kind, pattern in PATTERNS.items():
            for m in pattern.finditer(text):
                value = m[0]
                if kind == "ip" and any(int(x) > 255 for x in value.split(".")):
                    continue
                if kind == "phone" and not 7 <= sum(c.isdigit() for c in value) <= 15:
                    continue
                if kind == "iban":
                    plain = value.replace(" ", "")
                    if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 != 1:
                        continue
                spans.append((m.start(), m.end(), kind))
    for m in NAME.finditer(text):
        if m[0].lower() in GENDER_OF and (n := FOLLOWING.match(text, m.end())):  # alone it may be any word
            last = list(NAME.finditer(n[0]))[-1]
            spans += [(m.start(), m.end(), "given"), (m.end() + last.start(), m.end() + last.end(), "surname")]
    for m in TITLED.finditer(text):
        if n := NAME.match(text, m.end()):
            spans.append((n.start(), n.end(), "given" if n[0].lower() in GENDER_OF else "surname"))
    out, end = [], 0
    rank = ["email", *PATTERNS]
    for span in sorted(set(spans), key=lambda s: (s[0], -s[1], rank.index(s[2]) if s[2] in rank else 0)):
        if span[0] >= end:
            out.append(span)
            end = span[1]
    known = {text[a:b].lower(): kind for a, b, kind in out if kind in ("given", "surname") and b - a > 2}
    if known:  # a name that stands alone is the same person's
        taken, k = list(out), 0  # in order, as the names are
        for m in NAME.finditer(text):
            while k < len(taken) and taken[k][1] <= m.start():
                k += 1
            if m[0].lower() in known and (k == len(taken) or taken[k][0] >= m.end()):
                out.append((m.start(), m.end(), known[m[0].lower()]))
        out.sort()
    return out


def _round(key: bytes, tweak: str, turn: int, half: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{tweak}|{turn}|{half}".encode(), key=key[:64], digest_size=32).digest(), "big")


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of the numbers below ``size``: a Feistel network, repeated until it stays in range."""
    if size < 2:
        return value
    half = max(1, -(-(size - 1).bit_length() // 2))
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for turn in range(6):
            left, right = right, left ^ (_round(key, tweak, turn, right) & mask)
        value = left << half | right
        if value < size:
            return value


def _reshape(value: str, key: bytes, tweak: str, classes: list[str | None]) -> str:
    """The characters of ``value`` that have a class permuted together within their classes."""
    number, size = 0, 1
    for c, chars in zip(value, classes, strict=True):
        if chars:
            number, size = number * len(chars) + chars.index(c), size * len(chars)
    shape = "".join(str(ALPHABETS.index(k)) if k in ALPHABETS else "h" if k else c for c, k in zip(value, classes, strict=True))
    number = permute(number, size, key, f"{tweak}|{shape}")
    out = []
    for c, chars in zip(reversed(value), reversed(classes), strict=True):
        if chars:
            number, digit = divmod(number, len(chars))
            c = chars[digit]
        out.append(c)
    return "".join(reversed(out))


def _wider(stem: str, draw: int) -> str:
    """The stem with a letter of its script more for every draw from ``WIDER`` on."""
    pair = next((p for p, first, last in (("ен", "а", "я"), ("εν", "α", "ω")) if any(first <= c <= last for c in stem)), "en")
    return stem + "".join(pair[i % 2] for i in range(max(0, draw - WIDER + 1)))


def canonical(kind: str, text: str) -> str:
    """What all spellings of an entity share."""
    if kind in ("phone", "card"):
        plus = "+" if kind == "phone" and text.startswith("+") else ""
        return plus + re.sub(r"\D", "", text)
    if kind == "ip":
        return ".".join(str(int(x)) for x in text.split("."))
    if kind == "iban":
        return text.replace(" ", "")
    if kind == "secret" and not re.fullmatch(r"[0-9a-fA-F]+", text):
        return text
    return text.lower()


def surrogate(kind: str, value: str, key: bytes, draw: int = 0) -> str:
    """The canonical surrogate of a canonical entity."""
    tweak = f"{kind}|{draw}"
    if kind == "ip":
        address = ipaddress.ip_address(value)
        for net in PRIVATE:
            if address in net:
                first = int(net.network_address)
                return str(ipaddress.ip_address(first + permute(int(address) - first, net.num_addresses, key, f"{tweak}|{net}")))
        number = int(address)
        while True:
            number = permute(number, 1 << 32, key, tweak)
            other = ipaddress.ip_address(number)
            same = (other.is_multicast, other.is_reserved) == (address.is_multicast, address.is_reserved)
            if same and not any(other in net for net in PRIVATE):
                return str(other)
    if kind == "card":
        body, shift = value[:-1], (int(value[-1]) - _luhn(value[:-1])) % 10
        body = body[:1] + _reshape(body[1:], key, tweak + body[:1], [ALPHABETS[0]] * (len(body) - 1))
        return body + str((_luhn(body) + shift) % 10)
    if kind == "iban":
        body = _reshape(value[4:].lower(), key, tweak + value[:2], [CLASS_OF.get(c) for c in value[4:].lower()]).upper()
        check = 98 - int("".join(str(int(c, 36)) for c in body + value[:2] + "00")) % 97
        return f"{value[:2]}{check:02d}{body}"
    if kind == "given":
        names = [n.lower() for n in GIVEN_NAMES[GENDER_OF[value]]]
        place = permute(names.index(value), len(names), key, f"{tweak}|{GENDER_OF[value]}")
        return names[place]
    if kind == "phone":
        keep = 2 if value.startswith("+") else 0
        return value[:keep] + _reshape(value[keep:], key, tweak + value[:keep], [ALPHABETS[0]] * (len(value) - keep))
    if kind == "email":
        local, _, domain = value.partition("@")
        value = f"{_wider(local, draw)}@{domain}"
        keep = len(domain) - domain.rindex(".")
        classes = [CLASS_OF.get(c) for c in value[: len(value) - keep]] + [None] * keep
        return _reshape(value, key, tweak, classes)
    if kind == "surname":
        ending = GENDERED.search(value)
        keep = len(ending[0]) if ending and len(ending[0]) < len(value) else 0
        stem = _wider(value[: len(value) - keep], draw)
        return _reshape(stem + value[len(value) - keep :], key, tweak, [CLASS_OF.get(c) for c in stem] + [None] * keep)
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+", value):
        return _reshape(value, key, tweak, [HEX] * len(value))
    lower = value.lower()
    return _dressed(_reshape(lower, key, tweak, [CLASS_OF.get(c) for c in lower]), value) if kind == "secret" else _reshape(value, key, tweak, [CLASS_OF.get(c) for c in value])


def _dressed(new: str, old: str) -> str:
    """``new`` in the case of ``old``; past its end, in the case of its last letter."""
    upper = old.isupper() and len(old) > 1
    return "".join(c.upper() if upper or (i < len(old) and old[i].isupper()) else c for i, c in enumerate(new))


def written(kind: str, text: str, value: str) -> str:
    """A canonical surrogate in the format of the text it replaces."""
    if kind in ("phone", "card", "iban", "ssn"):
        chars = iter(value.lstrip("+"))
        return "".join(next(chars, c) if c.isalnum() else c for c in text)
    return _dressed(value, text)


def entities(docs: DataFrame) -> DataFrame:
    """``(kind, value)`` of every entity in ``docs(text)``, each once for a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {(kind, canonical(kind, text[a:b])) for text in batch.column(0).to_pylist() if text for a, b, kind in find(text)}
            kinds, values = zip(*sorted(found), strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], ["kind", "value"])

    return docs.select("text").mapInArrow(run, "kind string, value string").distinct()


def draws(found: DataFrame, key: bytes) -> DataFrame:
    """``(kind, value, draw)`` of the entities that need another draw than the first.

    A draw fails if its surrogate is another entity's original, or another entity's surrogate. Given names, whose
    lists are closed, are exchanged among themselves and only have to stay apart. Names and mailboxes whose shape has no
    free value, such as initials that all occur, become longer.
    """

    def made(df: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = zip(*[c.to_pylist() for c in batch.columns], strict=True)
                new = [surrogate(kind, value, key, draw) for kind, value, draw in rows]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], ["kind", "value", "draw", "new"])

        return df.select("kind", "value", "draw").mapInArrow(run, "kind string, value string, draw int, new string")

    now = stored(made(found.withColumn("draw", F.lit(0))), "draws")
    for _ in range(MOST_DRAWS):
        real = found.select("kind", F.col("value").alias("new")).where("kind <> 'given'")
        hit = now.join(real, ["kind", "new"], "left_semi").select("kind", "value")
        shared = now.groupBy("kind", "new").agg(F.count("*").alias("n"), F.min("value").alias("first")).where("n > 1")
        shared = now.join(shared, ["kind", "new"]).where("value <> first").select("kind", "value")
        bad = stored(hit.unionByName(shared).distinct(), "failed")
        if bad.isEmpty():
            return now.where("draw > 0").select("kind", "value", "draw")
        again = made(now.join(bad, ["kind", "value"]).select("kind", "value", (F.col("draw") + 1).alias("draw")))
        now = stored(now.join(bad, ["kind", "value"], "left_anti").unionByName(again), "draws")
    raise ValueError("no distinct surrogates were found; the key space of a shape is too small")


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, text, entities`` (array of begin, end and type in the input text).

    Null texts stay null and hold no entity. Equal rows fare alike; null ids are kept; extra columns are ignored; an
    empty table gives no rows. Without the key, surrogates can't be traced back.
    """
    secret = hashlib.sha256(key.encode()).digest()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = stored(entities(rows), "entities")
    other = stored(draws(found, secret), "redrawn")

    where = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(th, kind, canonical(kind, text[a:b])) for th, text in zip(*[c.to_pylist() for c in batch.columns], strict=True) if text for a, b, kind in find(text)]
            th, kind, value = zip(*set(rows), strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(th, pa.int64()), pa.array(kind, pa.string()), pa.array(value, pa.string())], ["th", "kind", "value"])

    joined = rows.withColumn("th", where)
    if other.isEmpty():
        joined = joined.select("id", "text", F.lit(None).cast("array<struct<kind:string,value:string,draw:int>>").alias("redrawn"))
    else:
        seen = joined.select("th", "text").mapInArrow(places, "th long, kind string, value string").distinct().join(other, ["kind", "value"])
        listed = stored(seen.groupBy("th").agg(F.collect_list(F.struct("kind", "value", "draw")).alias("redrawn")), "places")
        joined = joined.join(listed, "th", "left").select("id", "text", "redrawn")
    spans = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType())]))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("text", T.StringType()), T.StructField("entities", spans)])
    kind_type = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, places = [], []
            for text, redrawn in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                spans = find(text) if text else []
                if spans:
                    draw = {(x["kind"], x["value"]): x["draw"] for x in redrawn or ()}
                    parts, end = [], 0
                    for a, b, kind in spans:
                        value = canonical(kind, text[a:b])
                        parts += [text[end:a], written(kind, text[a:b], surrogate(kind, value, secret, draw.get((kind, value), 0)))]
                        end = b
                    text = "".join([*parts, text[end:]])
                texts.append(text)
                places.append([{"begin": a, "end": b, "kind": k} for a, b, k in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(places, kind_type)], schema.names)

    return joined.mapInArrow(run, schema)
