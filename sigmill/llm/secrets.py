"""Secret scans: fixed patterns, and a character network over every candidate and its surroundings.

Base findings come from three patterns. Candidates are, wherever they stand: runs of 8 and more of [A-Za-z0-9+/_.=-] with
a letter and a digit; runs of 12 and more in which capitals follow small letters twice; 12 and more digits, with hyphens
between them or not; and whatever run of 6 and more a word such as password, key or bearer leads to. Hyphens and full
stops at their ends do not belong to them. Each, inside base findings too, is judged by a byte-level convolutional
network that sees the whole run between 32 characters before it and 16 after. Of the labelled findings three fifths
train it, one fifth calibrates its probabilities (Platt) and the last sets the threshold: the largest that keeps a
recall of `RECALL`. Candidates at the threshold that touch no base finding become spans of kind "model".

Offsets count code points, ends are exclusive. A null text counts as empty. Repeated rows are each scanned.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byteconv import ByteConvNet, sigmoid

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # the runs of 20 and more characters
HEX = re.compile(r"[0-9a-f]{24,}")
_RUN, _START = "[A-Za-z0-9+/_.=-]", "(?<![A-Za-z0-9+/_.=-])"
CANDIDATE = re.compile(
    rf"""{_START}(?:(?=[A-Za-z+/_.=-]*[0-9])(?=[0-9+/_.=-]*[A-Za-z]){_RUN}{{8,}}|(?=(?:{_RUN}*?[a-z][A-Z]){{2}}){_RUN}{{12,}}|[0-9](?:-?[0-9]){{11,}}(?!{_RUN}))"""
)
LED = re.compile(rf"""(?ai)(?<![a-z])(?:api|access|account|private)?(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|key|auth|credentials?|bearer|login)(?:_[a-z_]{{0,12}}|s)?["']?(?:\x20+(?:is|are|was|will\x20be|value))?\x20*(?:[:=]\x20*)?["'`]?({_RUN}{{6,}})""")
BEFORE, AFTER = 32, 16
RECALL = 0.95
FINDINGS = 6_000


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans in order, each once."""
    found = {m.span() for m in CANDIDATE.finditer(text)} | {m.span(1) for m in LED.finditer(text)}
    spans = {(a + len(run) - len(run.lstrip(".-")), a + len(run.rstrip(".-"))) for a, b in found for run in (text[a:b],)}
    return sorted((a, b) for a, b in spans if b - a >= 6)


def in_context(text: str, a: int, b: int) -> bytes:
    """The candidate between marks, with its surroundings."""
    return f"{text[max(0, a - BEFORE):a]}\x01{text[a:b]}\x02{text[b:b + AFTER]}".encode("utf-8", "replace")


def labelled_findings(n: int = FINDINGS, seed: int = 11) -> list[tuple[str, int, int, int]]:
    """(text, start, end, 1 for a secret), made by rule: keys and passwords in the places where they leak, and in ordinary
    places the long identifiers, paths, names, numbers and words that look like candidates."""
    rng = random.Random(seed)
    pick = lambda alphabet, n: "".join(rng.choices(alphabet, k=n))
    alnum, b64, lower, digits = string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_lowercase, string.digits
    onset, vowel, coda = "b c d f g h k l m n p r s t v w st tr pl ch sh".split(), "a e i o u ai ou é ö ü ñe ie".split(), ["", "", "n", "r", "s", "l", "t", "nd", "ck"]
    syllable = lambda: rng.choice(onset) + rng.choice(vowel) + rng.choice(coda)
    word = lambda least=1: "".join(syllable() for _ in range(rng.randint(least, 4))).encode("ascii", "ignore").decode()
    prose = lambda k: " ".join("".join(syllable() for _ in range(rng.randint(1, 3))) + rng.choice(("", "", "", ",", ".", "!", "...", "&", "$", "%", "###")) for _ in range(k)) + rng.choice(("", ".", ",", "\n"))

    def key() -> str:
        return rng.choice((
            lambda: pick(b64, 40), lambda: pick(alnum, rng.randint(16, 64)), lambda: rng.choice(("ghp_", "gho_", "glpat-", "npm_", "hf_")) + pick(alnum, 36),
            lambda: rng.choice(("sk_live_", "rk_test_", "sk-", "pk_")) + pick(alnum, rng.randint(20, 32)), lambda: rng.choice(("xoxb-", "xoxp-")) + pick(digits, 12) + "-" + pick(alnum, 24),
            lambda: "eyJ" + pick(alnum, 33) + rng.choice(("", "." + pick(alnum, 40) + "." + pick(alnum, 43))), lambda: pick(b64, 43) + "=", lambda: "AIza" + pick(alnum + "_-", 35),
            lambda: pick(string.ascii_uppercase + digits, rng.randint(16, 32)), lambda: pick(string.hexdigits.lower(), rng.choice((32, 40, 64))), lambda: pick(string.ascii_letters, rng.randint(20, 40)),
        ))()

    def password() -> str:
        return rng.choice((
            lambda: word().title() + pick(digits, rng.randint(2, 4)) + pick("_-+=", rng.randint(0, 2)) + pick(lower, 2), lambda: pick(alnum, rng.randint(8, 15)), lambda: word(2) + rng.choice("-_.") + word(2) + rng.choice("-_.") + pick(digits, 2),
            lambda: pick(string.ascii_letters, rng.randint(8, 14)), lambda: pick(lower, 2) + pick(digits, 3) + pick(string.ascii_uppercase, 3) + pick(digits, 2),
        ))()

    def plain() -> str:
        return rng.choice((
            lambda: "-".join((*(word() for _ in range(rng.randint(2, 4))), str(rng.randint(1, 2030)))),
            lambda: "/".join(("usr", "lib", word() + str(rng.randint(1, 9)), word(), word())),
            lambda: f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}-report",
            lambda: "_".join((word(), word(), word(), "v" + str(rng.randint(1, 99)))),
            lambda: word().upper() + "-" + pick(digits, 4) + "-" + pick(digits, 4) + "-" + word(),
            lambda: "".join(word().title() for _ in range(4)) + str(rng.randint(1, 999)),
            lambda: "".join((word(), word(), word(), str(rng.randint(10, 99)))),
            lambda: f"{pick('0123456789abcdef', 8)}-{pick('0123456789abcdef', 4)}-4{pick('0123456789abcdef', 3)}-a{pick('0123456789abcdef', 3)}-{pick('0123456789abcdef', 12)}",
            lambda: "=" * rng.randint(10, 20) + word() + str(rng.randint(1, 99)) + "-" * rng.randint(3, 9),
            lambda: f"+{pick(digits, 2)}-{pick(digits, 3)}-{pick(digits, 4)}-{pick(digits, 4)}".lstrip("+"), lambda: f"978-{pick(digits, 1)}-{pick(digits, 4)}-{pick(digits, 4)}-{pick(digits, 1)}",
            lambda: f"{word(2)}{rng.randint(1990, 2030)}.{rng.choice(('pdf', 'html', 'jpg', 'csv'))}", lambda: f"www.{word(2)}{rng.randint(1, 99)}.example.com/{word()}/{rng.randint(1, 9999)}",
            lambda: "".join(word().title() for _ in range(rng.randint(3, 5))), lambda: word() + "." + word() + str(rng.randint(1, 99)), lambda: pick(digits, rng.randint(9, 19)), lambda: pick(digits, 16), lambda: word() + "." + pick(digits, 2),
        ))()

    leads = ("key: ", "AWS_SECRET_ACCESS_KEY=", "Authorization: Bearer ", '"private_key": "', "AccountKey=", "credentials ", "auth ", "export KEY=", "client id and key ", " ")
    asked = ("my password is ", "password: ", "login: ", "the passphrase is ", "pwd ", "passcode: ", "user admin pass ", "credentials are ", "the secret is ", "auth token ")
    calm = ("see ", "file ", "request id ", "in ", "page ", "module ", "the ", "version ", "https://example.com/", "tel ", "isbn ", "order ", " ")
    topic = ("the key ", "a token ", "password ", "secret ", "login ", "keyboard ", "the keys are ", "author ", "authority ", "passage ", "bearer ", "monkey ")
    rows = []
    for k in range(n):
        secret, kind = k % 2, rng.random()
        if secret:
            value, lead = (key(), rng.choice(leads)) if kind < 0.6 else (password(), rng.choice(asked))
            lead = "" if value == "" or kind < 0.15 else lead  # a long key may stand alone
        else:
            value, lead = (plain(), rng.choice(calm)) if kind < 0.6 else (word(3), rng.choice(topic)) if kind < 0.9 else (plain(), rng.choice(topic[-6:]))
            if kind < 0.2:  # either part of an address
                name, host = word() + "." + pick(digits, 2), ".".join((rng.choice((word(), word() + pick(digits, rng.randint(1, 2)), rng.choice(("smtp", "imap", "mx", "post")) + pick(digits, 1))), word(2), rng.choice(("com", "org", "net", "de", "info"))))
                value, lead = (host, rng.choice(("", lead)) + name + "@") if kind < 0.12 else (word(2) + "." + pick(digits, 2), rng.choice(("", lead)))
            elif kind < 0.4:  # a long number
                value, lead = pick(digits, rng.choice((12, 13, 14, 15, 16, 16, 16, 18, 19))), rng.choice(("", "", lead))
        value = value if len(value) >= 6 else value + word(2)
        lead = prose(rng.randint(2, 5)) + " " + lead
        text = lead + value + rng.choice((" ", '" ', ". ", "\n")) + prose(3)
        rows.append((text, len(lead), len(lead) + len(value), secret))
    return rows


class SecretModel:
    def __init__(self, net: ByteConvNet, slope: float, shift: float, threshold: float):
        self.net, self.slope, self.shift, self.threshold = net, slope, shift, threshold

    def probability(self, items: list[bytes]) -> np.ndarray:
        return sigmoid(self.slope * self.net.logits(items) + self.shift)


@lru_cache(maxsize=4)
def trained(recall: float = RECALL, n: int = FINDINGS, seed: int = 11) -> SecretModel:
    """The model of the generated findings, trained once in a process."""
    return train(labelled_findings(n, seed), recall)


def train(findings: list[tuple[str, int, int, int]], recall: float = RECALL) -> SecretModel:
    """Of every ten findings six train, two calibrate and two set the threshold."""
    items = [in_context(t, a, b) for t, a, b, _ in findings]
    y, part = np.array([r[3] for r in findings]), np.arange(len(findings)) % 10
    of = lambda some: [items[k] for k in np.flatnonzero(some)]
    net = ByteConvNet(chunk=64, stride=48, embed=6, filters=32).fit(of(part < 6), y[part < 6], epochs=16)
    held = (part == 6) | (part == 7)
    z, want, a, c = net.logits(of(held)), y[held], 1.0, 0.0
    for _ in range(300):  # Platt scaling by gradient steps on the mean loss
        d = sigmoid(a * z + c) - want
        a, c = a - 0.1 * float((d * z).mean()) / max(1.0, float((z * z).mean())), c - 0.1 * float(d.mean())
    positive = np.sort(sigmoid(a * net.logits(of((part > 7) & (y == 1))) + c))
    return SecretModel(net, a, c, float(positive[int((1 - recall) * len(positive))]) if len(positive) else 1.0)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, model: SecretModel | None = None) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_candidates, top_score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model or trained())
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_candidates", "top_score"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found, runs, items = [], [], []
                for x in batch.column(1):
                    text = x.as_py() or ""
                    found.append(base_spans(text))
                    runs.append(candidates(text))
                    items += [in_context(text, a, b) for a, b in runs[-1]]
                p, k, rows = judge.probability(items), 0, []
                for doc_id, base, own in zip(batch.column(0).to_pylist(), found, runs, strict=True):
                    scores = p[k : k + len(own)]
                    k += len(own)
                    more = [("model", a, b) for (a, b), s in zip(own, scores.tolist(), strict=True) if s >= judge.threshold and not any(a < d and c < b for _, c, d in base)]
                    spans = sorted(base + more, key=lambda x: (x[1], KINDS.index(x[0])))
                    count = [sum(kind == x[0] for x in base) for kind in KINDS[:3]]
                    rows.append((doc_id, *count, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(own), float(scores.max()) if len(own) else None))
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(types)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_candidates long, top_score double")
