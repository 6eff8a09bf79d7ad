"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Seven kinds. E-mail, network, card and phone spans are decided by their
pattern and checksum alone and always stay, whatever their score. IBANs
(mod-97), national ids (no checksum) and secrets (long runs that look drawn at random, by their
entropy) are added when their score, raised or
lowered by words close to them, reaches ``MIN_SCORE``. Context words are English, German, French and Spanish.

Offsets are code points, ends exclusive. Matches of one kind do not overlap;
spans of different kinds may.

Edge cases: a NULL text counts as empty and has no spans; ``redact`` keeps it
NULL. Repeated rows and ids are judged row by row. Texts of any length are
scanned whole, in time linear in their length. Extra columns are ignored by
``find`` and kept by ``redact``.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import map_texts

KINDS = ("email", "ip", "card", "phone", "iban", "national_id", "secret")
BASE_KINDS = KINDS[:4]
MIN_SCORE = 0.5
# Characters before and after a span in which its context words are looked for.
CONTEXT = 40
# kind: score without context, words that raise it by 0.3
SCORES = {
    "email": (0.9, ("mail", "contact", "write", "kontakt", "courriel", "correo", "contacto")),
    "ip": (0.6, ("ip", "address", "host", "server", "adresse", "dirección", "serveur", "servidor")),
    "card": (0.8, ("card", "credit", "visa", "payment", "karte", "zahlung", "carte", "tarjeta", "pago")),
    "phone": (0.6, ("phone", "call", "tel", "mobile", "fax", "anruf", "handy", "appel", "móvil", "llama")),
    "iban": (0.8, ("iban", "bank", "account", "konto", "compte", "cuenta", "banque", "banco")),
    "national_id": (0.3, ("ssn", "social security", "national id")),
    "secret": (0.3, ("token", "secret", "password", "passwd", "api.?key", "access.?key", "bearer", "passwort", "mot de passe", "contraseña")),
}
# Words that lower a score by 0.3.
DOUBT = ("example", "sample", "order no", "serial", "version", "isbn")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The first part must reach to the end of its digits, so it is tried from their begin only, and never shortened.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9_/+=-])[A-Za-z0-9_-]{16,256}(?![A-Za-z0-9_/+-])")
# Bits a character that a secret has at least; it also has letters and digits.
_RANDOM = 3.0
_HINT = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def looks_random(word: str) -> bool:
    n = len(word)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(word).values())
    return entropy >= _RANDOM and any(c.isdigit() for c in word) and any(c.isalpha() for c in word)


def _emails(text: str):
    """Leftmost matches, found from each @: the local part is the run of its characters before it."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _score(kind: str, text: str, start: int, end: int) -> float:
    score, words = SCORES[kind]
    near = (text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]).lower()
    if any(re.search(rf"\b{w}", near) for w in words):
        score += 0.3
    if any(w in near for w in DOUBT):
        score -= 0.3
    return round(min(1.0, max(0.0, score)), 3)


def spans_of(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of one text, by start, then kind in the order of KINDS."""
    if not text or not _HINT.search(text):
        return []
    found = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = re.sub(r"[\x20-]", "", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
                    found.append(("phone", m.start(), m.end()))
        for m in _IBAN.finditer(text):
            number = m[0].replace(" ", "")
            if 15 <= len(number) <= 34 and mod97(number):
                found.append(("iban", m.start(), m.end()))
        found += [("secret", m.start(), m.end()) for m in _SECRET.finditer(text) if looks_random(m[0])]
        found += [("national_id", m.start(), m.end()) for m in _NATIONAL.finditer(text)]
    scored = [(kind, s, e, _score(kind, text, s, e)) for kind, s, e in found]
    kept = [x for x in scored if x[0] in BASE_KINDS or x[3] >= MIN_SCORE]
    return sorted(kept, key=lambda x: (x[1], KINDS.index(x[0])))


def masked(text: str | None) -> str | None:
    """The text with each run of overlapping spans replaced by its first kind in brackets."""
    spans = spans_of(text)
    if not spans:
        return text
    out, done, i = [], 0, 0
    while i < len(spans):
        kind, start, end, _ = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join([*out, text[done:]])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its spans, an array of (kind, start, end, score)."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    inner = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [
            [dict(zip(("kind", "start", "end", "score"), s)) for s in spans_of(text)]
            for text in batch.column(1).to_pylist()
        ]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(inner))], names=["doc_id", "spans"])

    return map_texts(
        source, "text", run, f"doc_id {kind}, spans array<struct<kind string, start bigint, end bigint, score double>>"
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with personal data masked in ``text_col``; other columns unchanged."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        i = batch.schema.get_field_index(text_col)
        texts = pa.array([masked(t) for t in batch.column(i).to_pylist()], batch.schema.field(i).type)
        return batch.set_column(i, batch.schema.field(i), texts)

    return map_texts(docs, text_col, run, docs.schema)
