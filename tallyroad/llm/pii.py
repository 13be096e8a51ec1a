"""Personal data: fixed patterns, and spans found by weak supervision.

The four base kinds are plain patterns with a check. Further spans come from
candidates: written-out mail addresses, digit groups, and capitalised words
after a title or a given name. Labelers vote on every candidate (personal, not,
or no opinion): patterns, checksums, gazetteers, words around it. Votes are
counted by pattern over all documents, expectation-maximisation estimates how
reliable each labeler is and how likely each vote pattern means personal data,
and a logistic span classifier learns these likelihoods from the look and the
surroundings of a bounded sample of candidates. It decides which candidates are
reported; ``contact``, ``number`` and ``name`` are their kinds. One that
overlaps a base span is not reported, as the base span covers it.

Positions are code points, ends exclusive. A null or empty text has no spans.
Every pattern takes time in proportion to the text, whatever its length. A
score equal to the threshold counts as reached. Without any candidate the model
reports nothing; repeated rows count as often as they occur.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyroad.llm.places import Scratch

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("contact", "number", "name")
KINDS = BASE_KINDS + ADDED_KINDS
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"

# The base patterns. Repetitions that no shorter match can
# continue are possessive, so that a search never goes back.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    total = sum(map(int, odd)) + sum(2 * int(d) - 9 * (d > "4") for d in even)
    return total % 10 == 0


def byte_parts(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def mails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with what may stand before it, and a domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind number, start, end)`` in this order."""
    found = [(0, s, e) for s, e in mails(text)]
    found += [(1, m.start(), m.end()) for m in IP.finditer(text) if byte_parts(m[0])]
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 37:  # 19 digits and 18 separators
            digits = digits_of(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


# Words that labelers look for, in the four languages of the
# corpus. Titles and given names also start candidates for names.
TITLES = frozenset("mr mrs ms miss dr prof herr frau monsieur madame mme mlle señor señora don doña".split())
GIVEN_NAMES = frozenset(
    "alice anna anne antonio barbara carlos carmen charles christine claire claude daniel david elena elizabeth emma "
    "francisco franz george hans heinrich helmut isabel jacques james jean jennifer john jose josé joseph juan "
    "julia jürgen karen karl klaus laura linda louis luis manuel marc margaret maria maría marie martin mary michael "
    "michel monika nathalie nicolas patricia paul pedro peter petra philippe pierre richard robert sabine sarah "
    "sophie stefan susan susanne thomas ursula werner william wolfgang".split()
)
NO_NAMES = frozenset(
    "the and january february march april may june july august september october november december monday tuesday "
    "wednesday thursday friday saturday sunday montag dienstag mittwoch donnerstag freitag samstag sonntag lundi "
    "mardi mercredi jeudi vendredi samedi dimanche lunes martes miércoles jueves viernes sábado domingo street "
    "university company gmbh inc ltd airport hospital prize award theorem".split()
)
MAIL_HOSTS = frozenset("gmail googlemail hotmail outlook yahoo gmx web icloud aol proton protonmail orange free t-online".split())
MAIL_ENDS = frozenset("com org net edu de fr es eu uk us at ch be nl it info".split())
CALLING_CODES = ("+1", "+33", "+34", "+44", "+49", "+41", "+43", "+52", "+54", "0033", "0034", "0044", "0049")
NEAR_MAIL = frozenset("mail e-mail email contact reach write address adresse correo courriel schreiben escribir écrire".split())
NEAR_NUMBER = frozenset(
    "phone telephone tel call mobile cell fax dial whatsapp ssn card account iban passport telefon handy anruf "
    "anrufen konto karte ausweis téléphone portable appeler appelez carte compte teléfono móvil llamar llame "
    "tarjeta cuenta pasaporte".split()
)
NEAR_NAME = frozenset("name called am by from dear signed name: heiße heißt namens liebe lieber appelle nommé cher chère llamo llama querido querida".split())
NOT_PERSONAL = frozenset(
    "version release build order invoice item page pages isbn issn doi chapter section figure table sku part serial "
    "population total year code ticket bestellung rechnung seite artikel commande facture article pedido factura "
    "página artículo".split()
)

WORD = re.compile(r"[^\W\d_][\w'-]*+:?")
# Candidates. The at and dot signs are written out.
WRITTEN = re.compile(
    r"(?<![A-Za-z0-9._-])([A-Za-z0-9][A-Za-z0-9._-]{0,63}+)\x20?(?:\x20at\x20|\(at\)|\[at\]|\{at\})\x20?"
    r"([A-Za-z0-9-]{1,63}+)\x20?(?:\x20dot\x20|\(dot\)|\[dot\]|\{dot\})\x20?([A-Za-z]{2,12})(?![A-Za-z0-9])"
)
WRITTEN_SIGN = re.compile(r"[ (\[{]at[ )\]}]")
NUMBER = re.compile(r"(?<![0-9A-Za-z_+(.])\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+(?![0-9A-Za-z_])")
CAPITALISED = re.compile(r"(?<![\w'-])([A-ZÀ-ÖØ-Þ][\w'-]*+\.?)((?:\x20[A-ZÀ-ÖØ-Þ][\w'-]*+){1,3}+)")
DATE = re.compile(r"(?:[12][0-9]{3}[.-][0-9]{1,2}[.-][0-9]{1,2}|[0-9]{1,2}[.-][0-9]{1,2}[.-][12][0-9]{3})")
LOCAL_PHONE = re.compile(r"(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}")
IDENTITY = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
GROUPED_CARD = re.compile(r"(?:[0-9]{4}[\x20-]){3}[0-9]{4}")

LABELERS = ("shape", "counter", "checksum", "gazetteer", "no_gazetteer", "near", "near_other")
CONTEXT = 48
DIMENSIONS = 1 << 12


def context_words(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    left = text[max(0, start - CONTEXT) : start].lower()
    if start > CONTEXT:
        left = left[left.find(" ") + 1 :] if " " in left else ""
    return [w.rstrip(":") for w in WORD.findall(left)][-4:], [w.rstrip(":") for w in WORD.findall(text[end : end + 24].lower())][:1]


def vote(yes: bool, no: bool = False) -> str:
    return "+" if yes else "-" if no else "0"


def candidates(text: str) -> Iterator[tuple[str, int, int, str, list[str]]]:
    """``kind, start, end, votes, features`` of everything that may be
    personal data, base spans included: labelers are judged on those too."""
    for start, end in mails(text):
        yield described(text, "contact", start, end, text[start:end].split("@")[-1].lower().split("."), "@")
    if WRITTEN_SIGN.search(text):
        for m in WRITTEN.finditer(text):
            yield described(text, "contact", m.start(), m.end(), [m[2].lower(), m[3].lower()], "at")
    for m in NUMBER.finditer(text):
        yield described(text, "number", m.start(), m.end(), [], "")
    for m in CAPITALISED.finditer(text):
        opener = m[1].rstrip(".").lower()
        if opener in TITLES:
            yield described(text, "name", m.start(2) + 1, m.end(), m[2].lower().split(), "title")
        elif opener in GIVEN_NAMES and not m[1].endswith("."):
            yield described(text, "name", m.start(), m.end(), m[0].lower().split(), "given")


def described(text: str, kind: str, start: int, end: int, parts: list[str], how: str) -> tuple[str, int, int, str, list[str]]:
    span = text[start:end]
    before, after = context_words(text, start, end)
    near = set(before[-3:]) | set(after)
    features = [f"{kind}:{how}", f"{kind}:shape:{shape(span)}", *[f"{kind}:before:{w}" for w in before[-2:]]]
    if kind == "contact":
        host = parts[-2] if len(parts) > 1 else ""
        votes = (
            vote(how == "@" or parts[-1] in MAIL_ENDS, not parts[-1].isalpha()),
            vote(False, span[0] in ".-_" or ".." in span),
            "0",
            vote(host in MAIL_HOSTS or parts[-1] in MAIL_ENDS),
            vote(False, bool(set(parts) & {"localhost", "noreply", "invalid"})),
            vote(bool(near & NEAR_MAIL)),
        )
        features += [f"contact:end:{parts[-1]}", f"contact:known:{host in MAIL_HOSTS}"]
    elif kind == "number":
        digits = digits_of(span[:64])
        n = len(digits)
        shaped = bool(LOCAL_PHONE.fullmatch(span) or IDENTITY.fullmatch(span) or GROUPED_CARD.fullmatch(span))
        is_ip = bool(IP.fullmatch(span)) and byte_parts(span)
        long_run = 13 <= n <= 19
        votes = (
            vote(shaped or is_ip or (span[0] == "+" and 9 <= n <= 15), span.isdigit() or n > 19),
            vote(False, bool(DATE.fullmatch(span)) or len(set(digits)) <= 2 or span.count(".") > 3),
            vote(long_run and luhn(digits), long_run and not luhn(digits)),
            vote(span.startswith(CALLING_CODES) and 9 <= n <= 15),
            "0",
            vote(bool(near & NEAR_NUMBER)),
        )
        features += [f"number:digits:{min(n, 20)}", f"number:checked:{votes[2]}", f"number:near:{votes[5]}"]
    else:
        votes = (
            vote(how == "title" or len(parts) in (2, 3)),
            vote(False, any(c.isdigit() for c in span) or span.isupper()),
            "0",
            vote(bool(set(parts) & GIVEN_NAMES)),
            vote(False, bool(set(parts) & NO_NAMES)),
            vote(bool(near & NEAR_NAME)),
        )
        features += [f"name:words:{len(parts)}", f"name:given:{votes[3]}", f"name:other:{votes[4]}"]
    other = vote(False, bool(near & NOT_PERSONAL))
    features.append(f"{kind}:other:{other}")
    return kind, start, end, "".join((*votes, other)), features


def shape(span: str) -> str:
    """Classes of characters, runs cut at four."""
    classes = re.sub(r"[0-9]", "9", span[:48])
    classes = re.sub(r"[^\W\d_]", "a", classes)
    return re.sub(r"(.)\1{3,}", r"\1\1\1\1", classes)


def slots(features: Iterable[str]) -> list[int]:
    """Numbers of features; 0 is the bias."""
    hashed = (int.from_bytes(hashlib.blake2b(f.encode(), digest_size=4).digest()) for f in features)
    return [0, *(1 + h % (DIMENSIONS - 1) for h in hashed)]


@dataclass(frozen=True)
class Labels:
    """What expectation-maximisation found for one kind."""

    prior: float
    reliability: np.ndarray  # labeler, class, vote (-, 0, +)
    likely: dict[str, float]  # by vote pattern


VOTES = "-0+"


def estimate(counts: dict[str, int], tolerance: float = 1e-9, rounds: int = 2000) -> Labels:
    """Two classes, votes independent within a class. It starts from labelers
    that are right more often than not, and keeps it so: a vote for a class
    never becomes evidence against it. One vote of every sort is added."""
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    seen = np.array([[VOTES.index(v) for v in p] for p in patterns])
    at = np.arange(seen.shape[1])
    hot = np.eye(3)[seen]
    table = np.empty((seen.shape[1], 2, 3))
    table[:, 0], table[:, 1] = (0.3, 0.6, 0.1), (0.1, 0.6, 0.3)
    prior, last = 0.5, -np.inf
    for _ in range(rounds):
        logs = np.log(table)[at, :, seen].sum(1) + np.log([1 - prior, prior])
        whole = np.logaddexp(logs[:, 0], logs[:, 1])
        likely = np.exp(logs[:, 1] - whole)
        score = float(n @ whole)
        if score - last < tolerance * abs(score):
            break
        last = score
        weight = np.stack([n * (1 - likely), n * likely])
        prior = (weight[1].sum() + 1) / (n.sum() + 2)
        table = np.einsum("cp,plv->lcv", weight, hot) + 1
        table /= table.sum(2, keepdims=True)
        table = kept_sided(table)
    return Labels(prior, table, dict(zip(patterns, likely.tolist())))


def kept_sided(table: np.ndarray) -> np.ndarray:
    """Where a labeler's vote would speak against its class, both classes get
    the mean rate of that vote, and their other rates what is left. Where that
    turns the other vote, the labeler says nothing in this round."""
    out = table.copy()
    for v, side in ((2, 1), (0, 0)):
        for labeler in np.flatnonzero(out[:, side, v] < out[:, 1 - side, v]):
            rates = out[labeler]
            mean = rates[:, v].mean()
            rates *= ((1 - mean) / (1 - rates[:, v]))[:, None]
            rates[:, v] = mean
    turned = (out[:, 1, 2] < out[:, 0, 2] - 1e-12) | (out[:, 0, 0] < out[:, 1, 0] - 1e-12)
    out[turned] = table[turned].mean(1, keepdims=True)
    return out


def train(rows: list[list[int]], targets: np.ndarray, ridge: float = 1e-3, steps: int = 400) -> np.ndarray:
    """Weights of a logistic model of soft targets, by gradient steps with
    momentum on the mean loss."""
    weights = np.zeros(DIMENSIONS)
    if not rows:
        return weights
    of_row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    slot = np.array([s for r in rows for s in r])
    speed = np.zeros(DIMENSIONS)
    for _ in range(steps):
        found = 1 / (1 + np.exp(-np.bincount(of_row, weights[slot], len(rows))))
        gradient = loss_gradient(found, targets, of_row, slot, weights, ridge)
        speed = 0.9 * speed - 0.5 * gradient
        weights = weights + speed
    return weights


def loss_gradient(found, targets, of_row, slot, weights, ridge) -> np.ndarray:
    return np.bincount(slot, ((found - targets) / len(targets))[of_row], DIMENSIONS) + ridge * weights


@dataclass(frozen=True)
class Model:
    labels: dict[str, Labels]
    weights: np.ndarray
    threshold: float

    def score(self, features: list[str]) -> float:
        return float(1 / (1 + np.exp(-self.weights[slots(features)].sum())))


def votes_of(docs: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    """``kind, votes, slots, pick`` of every candidate of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                rows = [(k, v, slots(f), f"{key.as_py()}:{s}:{e}") for k, s, e, v, f in candidates(text)]
                for at in range(0, len(rows), 10_000):
                    part = list(zip(*rows[at : at + 10_000]))
                    kinds = (pa.string(), pa.string(), pa.list_(pa.int32()), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(part, kinds)], names=["kind", "votes", "slots", "pick"]
                    )

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = found.mapInArrow(run, "kind string, votes string, slots array<int>, pick string")
    return scratch.keep(found.withColumn("pick", F.xxhash64("pick", "kind")), "candidates")


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 20_000, threshold: float = 0.9
) -> Model:
    """Votes of all candidates are counted. The classifier learns from
    ``sample`` of them, chosen by a hash of document and position."""
    scratch = Scratch(docs.sparkSession)
    found = votes_of(docs, id_col, text_col, scratch)
    # At most three kinds and 3 ** 7 patterns.
    counted: dict[str, dict[str, int]] = {}
    for kind, votes, n in found.groupBy("kind", "votes").count().collect():
        counted.setdefault(kind, {})[votes] = n
    labels = {kind: estimate(counts) for kind, counts in sorted(counted.items())}
    rows = found.orderBy("pick", "kind", "votes").limit(sample).collect()
    targets = np.array([labels[r["kind"]].likely[r["votes"]] for r in rows])
    model = Model(labels, train([r["slots"] for r in rows], targets), threshold)
    scratch.drop(found)
    return model


def scan(text: str | None, model: Model) -> list[tuple[int, int, int]]:
    """All spans ``(kind number, start, end)`` of one text, in this order."""
    if not text:
        return []
    base = base_spans(text)
    covered = sorted((s, e) for _, s, e in base)
    found, at = [], 0
    for kind, start, end, _, features in sorted(candidates(text), key=lambda c: (c[1], c[2])):
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        # Candidates come by start, so earlier base spans are done with.
        if any(s < end and start < e for s, e in overlapping(covered, at, end)):
            continue
        if model.score(features) >= model.threshold:
            found.append((KINDS.index(kind), start, end))
    return sorted(base + found)


def overlapping(covered: list[tuple[int, int]], at: int, end: int) -> Iterator[tuple[int, int]]:
    while at < len(covered) and covered[at][0] < end:
        yield covered[at]
        at += 1


def find(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, spans``: one row per input row, spans sorted by kind (in the
    order of ``KINDS``) and start."""
    key = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            rows = [
                [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in scan(t.as_py(), model)] for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=[id_col, "spans"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {key}, spans {SPANS}")


def number_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
