"""Personal data: fixed patterns, and weakly supervised spans beside them.

The four base kinds are found by rule. Beside them, candidate spans of four more kinds (telephone numbers without a
country code, secrets, names of persons, street addresses) are looked for widely, ordinary words and numbers among them,
and get votes from labelers: regular expressions, gazetteers and the context of the span. Counts of vote patterns over
the whole corpus (a bounded number of patterns, whatever its size) feed expectation-maximisation, which estimates for each
kind how reliable each labeler is and how probable each pattern. These soft labels train the final span classifier, a
logistic regression a kind on features of the span and its context, whose weights go back to every document in a second
pass, where they alone decide: a candidate may be a span without any vote, or none in spite of one.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

# The base kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")
EXTRA = ("local_phone", "secret", "person", "address")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # starts inside a run of digits match nothing more
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each @ outwards: linear in any text."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield "email", start, m.end()
            free = m.end()
            at = text.find("@", free)
        else:
            free, at = at + 1, text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The base kinds, by kind as listed, then by start (code points, end exclusive)."""
    out = list(emails(text))
    for m in _IP.finditer(text):
        if all(len(q := p.lstrip("0")) <= 3 and int(q or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() and 13 <= len(digits := m.group().replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# Words that announce a secret, a telephone number, a person or an address; beginnings of well-known keys;
# common given names; words that end the name of a street.
SECRET_WORDS = ("token", "secret", "password", "passwd", "pwd", "passphrase", "apikey", "api_key", "api-key", "key", "auth", "bearer", "credential", "access", "private")
PHONE_WORDS = ("phone", "call", "tel", "mobile", "cell", "fax", "contact", "whatsapp", "sms", "telefon", "handy", "anruf", "téléphone", "portable", "teléfono", "móvil")
PERSON_WORDS = ("name", "contact", "dear", "signed", "author", "attn", "regards", "sincerely", "patient", "customer")
ADDRESS_WORDS = ("address", "at", "lives", "street", "adresse", "dirección", "located", "ship", "mail")
KEY_STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "glpat-", "sk_live_", "sk-", "pk_live_", "xoxb-", "xoxp-", "AIza", "eyJ", "hf_", "npm_")
GIVEN_NAMES = frozenset("""
    Alice Amanda Amy Andrea Andrew Anna Anthony Barbara Benjamin Brian Carlos Carmen Carol Catherine Charles Charlotte
    Christian Christine Christopher Claire Daniel David Deborah Diana Donald Dorothy Edward Elena Elizabeth Emily Emma Eric
    Frank Franz George Hans Heather Helen Henry Isabel Jacob James Jane Jason Javier Jean Jennifer Jessica Joan John Jonathan
    Jorge Joseph Juan Julia Karen Karl Katherine Kevin Klaus Laura Linda Lisa Luis Manuel Margaret Maria Marie Mark Martin
    Mary Matthew Melissa Michael Michelle Miguel Monika Nancy Nicholas Nicole Olivia Pablo Patricia Patrick Paul Peter Pierre
    Rachel Rebecca Richard Robert Ronald Ruth Sandra Sarah Sharon Sophie Stephen Steven Susan Thomas Timothy Victoria William
""".split())
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Señor", "Señora", "Monsieur", "Madame")
STREETS = ("Street", "St", "Avenue", "Ave", "Road", "Rd", "Lane", "Ln", "Boulevard", "Blvd", "Drive", "Dr", "Court", "Ct", "Place", "Square", "Way", "Terrace", "Parkway", "Highway")
_SECRET = re.compile(r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{16,}+={0,2}")
# These begin with a set of characters, which is found fast; what stands before them is looked at afterwards (``placed``).
_LOCAL_PHONE = re.compile(r"[(0-9][0-9]{1,3}\)?[ .-]?(?:[0-9]{2,4}[ .-]){1,4}?[0-9]{2,4}(?![0-9A-Za-z]|[.-][0-9])")
_PERSON = re.compile(r"[A-Z][a-z]++\.? (?:[A-Z]\. )?[A-Z][a-z]++(?: [A-Z][a-z]++)?(?!\w)")
_ADDRESS = re.compile(rf"[0-9]{{1,5}}[A-Za-z]? (?:[A-Z][a-z]+ ){{1,3}}(?:{'|'.join(STREETS)})\b\.?")
_HEX = re.compile(r"[0-9a-fA-F]+\Z")
_BEFORE = re.compile(r"([^\W\d]+)[\"']?\s*([=:])?\s*[\"'(]?\Z")
_SHAPE = re.compile(r"\(?[0-9]{3}[) .-] ?[0-9]{3}[ .-][0-9]{4}\Z")
_DATE = re.compile(r"(?:[12][0-9]{3}[.-][01]?[0-9][.-][0-3]?[0-9]|[0-3]?[0-9][.-][01]?[0-9][.-](?:[12][0-9])?[0-9]{2})\Z")
_RUNS = re.compile(r"[A-Za-z]+|[0-9]+")
# What must not stand before a span.
_NOT_BEFORE = {"local_phone": re.compile(r"[0-9A-Za-z+.(-]\Z"), "person": re.compile(r"[\w@]\Z"), "address": re.compile(r"[\w.]\Z")}
Candidate = tuple[str, int, int, tuple[int, ...], tuple[int, ...]]


def placed(kind: str, pattern: re.Pattern, text: str) -> Iterator[re.Match]:
    """Matches that begin where they may. One that doesn't is no match, so the search goes on behind its first character."""
    barred, at = _NOT_BEFORE.get(kind), 0
    while m := pattern.search(text, at):
        s = m.start()
        if barred and s and barred.search(text[s - 1]):
            at = s + 1
        elif kind == "person" and "." in (first := m.group().split(" ", 1)[0]) and first[:-1] not in TITLES:
            at = s + 1  # the end of a sentence and the beginning of the next
        else:
            yield m
            at = m.end()


def candidates(text: str, taken: list[Span]) -> Iterator[Candidate]:
    """Spans that are no base spans: kind, start, end, labelers' votes (1, 0 abstains, -1) and features (0 or 1)."""
    base = sorted((s, e) for _, s, e in taken)
    starts = [s for s, _ in base]
    ends = list(accumulate((e for _, e in base), max))
    for kind, pattern, judge in (("local_phone", _LOCAL_PHONE, phone_votes), ("secret", _SECRET, secret_votes), ("person", _PERSON, person_votes), ("address", _ADDRESS, address_votes)):
        for m in placed(kind, pattern, text):
            s, e = m.span()
            at = bisect_left(starts, e)
            if at and ends[at - 1] > s:
                continue
            before = _BEFORE.search(text[max(0, s - 40) : s])
            word, sign = (before.group(1).lower(), bool(before.group(2))) if before else ("", False)
            quoted = s > 0 and text[s - 1] in "\"'" and text[e : e + 1] == text[s - 1]
            yield kind, s, e, *judge(m.group(), word, sign, quoted, s == 0 or text[max(0, s - 2) : s].rstrip(" ")[-1:] in (".", "!", "?", "\n", ""))


def secret_votes(own: str, word: str, sign: bool, quoted: bool, begins: bool) -> tuple[tuple[int, ...], tuple[int, ...]]:
    runs = _RUNS.findall(own)
    digits = sum(len(r) for r in runs if r[0] in "0123456789")
    letters = max((len(r) for r in runs if r[0] not in "0123456789"), default=0)
    known, named = own.startswith(KEY_STARTS), any(w in word for w in SECRET_WORDS)
    hexed = bool(_HEX.match(own)) and 0 < digits < len(own)
    mixed = len(runs) >= 5 and 8 * digits >= len(own)
    votes = (
        1 if hexed and len(own) in (32, 40, 64) or known else 0,  # regular expression: shapes of keys and digests
        1 if named else 0,  # gazetteer: the word before
        1 if sign else 0,  # context: assignment
        1 if quoted else 0,  # context: quotation
        1 if mixed else -1 if len(runs) < 3 or not digits else 0,  # regular expression: letters and digits in turn
        -1 if "/" in own and not digits or letters > 12 else 0,  # regular expression: words and paths
    )
    spread = 2 * len(set(own)) >= min(len(own), 24)
    return votes, (hexed, known, mixed, spread, own.isupper(), any(c.isupper() for c in own) and any(c.islower() for c in own), len(own) >= 20, len(own) >= 32, 5 * digits >= len(own), digits == 0, letters > 6, letters > 12, "/" in own, named, sign, quoted)


def phone_votes(own: str, word: str, sign: bool, quoted: bool, begins: bool) -> tuple[tuple[int, ...], tuple[int, ...]]:
    digits = sum(c.isdigit() for c in own)
    named = any(w in word for w in PHONE_WORDS)
    shaped, date = bool(_SHAPE.match(own)), bool(_DATE.match(own))
    votes = (
        1 if shaped else 0,  # regular expression: the shape of a number
        1 if named else 0,  # gazetteer: the word before
        1 if own[0] == "(" else 0,  # regular expression: an area code
        -1 if date else 0,  # regular expression: dates
        -1 if not 7 <= digits <= 12 else 0,  # regular expression: length
    )
    return votes, (shaped, date, own[0] == "(", digits < 7, digits > 12, "-" in own, "." in own, " " in own, named, sign)


def person_votes(own: str, word: str, sign: bool, quoted: bool, begins: bool) -> tuple[tuple[int, ...], tuple[int, ...]]:
    parts = own.split()
    titled = parts[0].rstrip(".") in TITLES
    given = parts[titled] in GIVEN_NAMES if len(parts) > titled else False
    named = word in PERSON_WORDS
    votes = (
        1 if given else -1,  # gazetteer: given names
        1 if titled else 0,  # regular expression: a title
        1 if named else 0,  # context: the word before
        -1 if begins and not titled else 0,  # context: the first word of a sentence has a capital anyway
    )
    return votes, (given, titled, named, begins, len(parts) > 2, len(parts[-1]) > 10)


def address_votes(own: str, word: str, sign: bool, quoted: bool, begins: bool) -> tuple[tuple[int, ...], tuple[int, ...]]:
    parts = own.split()
    long_ = parts[-1].rstrip(".") not in ("St", "Dr", "Ct", "Way", "Place", "Court")
    named = word in ADDRESS_WORDS
    votes = (
        1,  # regular expression: number, name and street
        1 if named else 0,  # context: the word before
        1 if long_ else 0,  # gazetteer: words that only streets end with
        -1 if len(parts) > 4 else 0,  # regular expression: long names
    )
    return votes, (long_, named, len(parts) > 3, len(parts[0]) > 3, begins)


def reliabilities(patterns: dict[tuple[int, ...], float], rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns with weights: (per labeler its votes by class, posterior by pattern).

    Labelers are independent given the class; each has a probability of each of its three votes in either class. The
    start is the sum of the votes less one (a lone vote leaves a doubt), and smoothing holds that votes for a span are
    likelier where there is one; patterns without any vote for it count as class 0 throughout.
    """
    votes = np.array(list(patterns), np.int64) + 1
    weight = np.array(list(patterns.values()), float)
    backed = (votes == 2).any(1)
    post = np.where(backed, 1 / (1 + np.exp(1.0 - (votes - 1).sum(1))), 0.0)
    table = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        prior = np.array([((1 - post) * weight).sum() + 1, (post * weight).sum() + 1])
        for c, p in enumerate((1 - post, post)):
            for v in range(3):
                table[c, :, v] = ((votes == v) * (p * weight)[:, None]).sum(0) + (1 + (v if c else 2 - v))
        table /= table.sum(2, keepdims=True)
        prior /= prior.sum()
        logs = [np.log(prior[c]) + np.log(table[c][np.arange(votes.shape[1]), votes]).sum(1) for c in (0, 1)]
        post = np.where(backed, 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50))), 0.0)
    return table, post


def fit_logistic(features: np.ndarray, labels: np.ndarray, weight: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights (the intercept last) of a ridge logistic regression on soft labels, by Newton steps."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w, share = np.zeros(x.shape[1]), weight / max(weight.sum(), 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - labels)) + 1e-4 * w
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        w -= np.linalg.solve(hessian, gradient)
    return w


Weights = dict[str, np.ndarray]


def train(docs: DataFrame, text: str = "text") -> Weights | None:
    """Weights of the span classifier by kind, from the votes on all candidates of all documents; None without any.

    Each task sends one count per pattern of votes and features (binary, so at most some thousand patterns exist).
    """

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        found: Counter = Counter()
        for batch in batches:
            for t in batch["_text"].to_pylist():
                found.update((kind, votes, features) for kind, _, _, votes, features in candidates(t, base_spans(t)))
        yield {"kind": [k for k, _, _ in found], "votes": [list(v) for _, v, _ in found], "features": [list(map(int, f)) for *_, f in found], "n": list(found.values())}

    rows = docs.filter(F.col(text).isNotNull()).select(F.col(text).alias("_text"))
    counted = map_batches(rows, body, "kind string, votes array<int>, features array<int>, n bigint").groupBy("kind", "votes", "features").agg(F.sum("n").alias("n")).collect()
    return fitted([(k, tuple(v), tuple(f), n) for k, v, f, n in counted]) or None


def fitted(counted: list[tuple[str, tuple[int, ...], tuple[int, ...], int]]) -> Weights:
    """Kind by kind: soft labels of the vote patterns, and the classifier trained on them. A kind that no pattern speaks
    for has no classifier."""
    out: Weights = {}
    for kind in sorted({k for k, *_ in counted}):
        own = sorted(x[1:] for x in counted if x[0] == kind)
        patterns: Counter = Counter()
        for votes, _, n in own:
            patterns[votes] += n
        if not any(v == 1 for votes in patterns for v in votes):
            continue
        by = dict(zip(patterns, reliabilities(patterns)[1], strict=True))
        out[kind] = fit_logistic(np.array([f for _, f, _ in own], float), np.array([by[v] for v, _, _ in own]), np.array([n for *_, n in own], float))
    return out


def all_spans(text: str, weights: Weights | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and the classifier's spans beside them: none overlaps a base span or another, the leftmost (of these
    the longest) standing; by kind as listed, then by start."""
    base = base_spans(text)
    if not weights:
        return base, []
    found = [(s, -e, kind) for kind, s, e, votes, features in candidates(text, base) if kind in weights and float(np.dot(weights[kind][:-1], features)) + weights[kind][-1] > 0]
    more: list[Span] = []
    free = 0
    for s, e, kind in sorted(found):
        if s >= free:
            more.append((kind, s, -e))
            free = -e
    return base, sorted(more, key=lambda x: (EXTRA.index(x[0]), x[1]))


def find(docs: DataFrame, weights: Weights | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, base and more (arrays of kind, start, end). Null texts count as empty. One pass, no shuffle."""

    def body(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            found = [all_spans(t, weights) for t in batch["_text"].to_pylist()]
            as_rows = [[[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in both] for both in found]
            yield {key: batch[key], "base": [r[0] for r in as_rows], "more": [r[1] for r in as_rows]}

    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    return map_batches(rows, body, f"{key} {rows.schema[key].dataType.simpleString()}, base {spans}, more {spans}")


def joined(spans: list[dict]) -> str:
    order = {k: i for i, k in enumerate((*KINDS, *EXTRA))}
    return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in sorted(spans, key=lambda s: (order[s["kind"]], s["start"])))


def redact_text(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in brackets; spans that overlap are replaced as one."""
    out, free = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= free:
            out += [text[free:s], f"[{kind.upper()}]"]
        free = max(free, e)
    return "".join([*out, text[free:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with all found spans replaced in ``text``; rows, order of columns and null texts stay."""
    weights = train(docs, text)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            at = batch.schema.get_field_index(text)
            new = [None if t is None else redact_text(t, [x for both in all_spans(t, weights) for x in both]) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def digest(spans: list[dict]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
