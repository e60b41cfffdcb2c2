"""Secret scan: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Both models are first-order over characters with add-half smoothing, trained from labelled samples: random strings drawn
with a fixed seed over the usual alphabets, and identifiers that join words of the corpus in the usual styles. The words
come from a bounded sample of documents (SAMPLE_DOCS, those with the least hashed ids) and, beside them, from a rule that
joins syllables, so that an empty corpus gives a model too. A run of identifier characters that mixes letters and digits is
random if the log-likelihood ratio a character favours it. Its span is reported, whether a fixed pattern covers it or not;
fixed-pattern spans always stay.

Places are code points, end exclusive. Null and empty texts have no spans. Repeated ids are rows of their own. An empty
table gives no rows. Columns beside the text pass through as one struct, so their names can't clash.
"""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The patterns, in order of kind.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
ASSIGN_LEAST = 6
ASSIGN_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Mean log-likelihood ratio a character from which a candidate counts as random.
THRESHOLD = 0.75

#: Documents whose words the identifiers of the labelled sample are joined from, and words taken of each.
SAMPLE_DOCS = 400
SAMPLE_WORDS = 50


class Markov:
    """Log probabilities of a character after another, over printable ASCII."""

    def __init__(self, samples: list[str]):
        counts = np.full((128, 128), 0.5)
        for s in samples:
            codes = np.frombuffer(f"\x02{s}".encode("ascii"), np.uint8)
            np.add.at(counts, (codes[:-1], codes[1:]), 1)
        self.table = np.log(counts / counts.sum(axis=1, keepdims=True))


def syllable_words(rng: random.Random, n: int) -> list[str]:
    """Words that can be spoken: two to four of consonant, vowel and at times a closing consonant."""
    syllable = lambda: rng.choice("bcdfghlmnprstvw") + rng.choice("aeiou") + (rng.choice("lnrst") if rng.random() < 0.4 else "")
    return ["".join(syllable() for _ in range(rng.randint(2, 4))) for _ in range(n)]


def labelled_samples(words: list[str] = (), seed: int = 5, each: int = 20000) -> tuple[list[str], list[str]]:
    """Random strings and ordinary identifiers, in equal number; half of the identifiers' words are made, half are from words."""
    rng = random.Random(seed)
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alphabets = (lower + upper + digits, lower + upper + digits + "+/", lower + upper + digits + "-_", lower + digits, upper + digits, "0123456789abcdef")
    strange = ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(16, 48))) for _ in range(each)]
    made, plain = syllable_words(rng, 2000), []
    for _ in range(each):
        joined = rng.choices(words if words and rng.random() < 0.5 else made, k=rng.randint(2, 6))
        style = rng.randrange(6)
        joined = ("_".join(joined), "-".join(joined), "".join(w.title() for w in joined), joined[0] + "".join(w.title() for w in joined[1:]), "_".join(joined).upper(), "/".join(joined))[style]
        if rng.random() < 0.6:
            joined += rng.choice(("", "_", "-", "/", "v")) + str(rng.randrange(10 ** rng.randint(1, 8)))
        plain.append(joined)
    return strange, plain


def sampled_words(docs: DataFrame, documents: int = SAMPLE_DOCS, each: int = SAMPLE_WORDS) -> list[str]:
    """Distinct words of 3 to 12 ASCII letters, at most `each` of at most `documents` documents, the same ones each time."""
    rows = docs.select(F.xxhash64(F.col("doc_id").cast("string")).alias("h"), F.xxhash64("text").alias("th"))
    chosen = rows.orderBy("h", "th").limit(documents).distinct()
    least = docs.sparkSession.createDataFrame(chosen.collect(), rows.schema)  # two numbers a document of the sample
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"(?<![A-Za-z0-9])[a-z]{3,12}(?![A-Za-z0-9])"), F.lit(0))
    sample = docs.select(F.xxhash64(F.col("doc_id").cast("string")).alias("h"), F.xxhash64("text").alias("th"), "text").join(F.broadcast(least), ["h", "th"])
    words = sample.groupBy("h", "th").agg(F.min("text").alias("text")).select(F.slice(F.array_sort(F.array_distinct(found)), 1, each).alias("w"))
    return sorted({w for r in words.collect() for w in r["w"] or ()})


def ratio_table(words: list[str] = ()) -> np.ndarray:
    strange, plain = labelled_samples(words)
    return Markov(strange).table - Markov(plain).table


def likelihood_ratio(table: np.ndarray, text: str) -> float:
    """Mean over the characters of an ASCII string."""
    codes = np.frombuffer(f"\x02{text}".encode("ascii"), np.uint8)
    return float(table[codes[:-1], codes[1:]].mean())


def base_spans(text: str, runs: list[re.Match]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, kinds as places in KINDS. runs: the candidates, which hold any access key or hex run."""
    found, lower = [], text.lower()
    if any(key in lower for key in ASSIGN_KEYS):
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    for run in runs:
        found += [(m.start(), kind, m.end()) for kind, pattern in ((1, ACCESS), (2, HEX)) for m in pattern.finditer(text, run.start(), run.end())]
    return sorted(found)


def random_spans(runs: list[re.Match], table: np.ndarray) -> list[tuple[int, int, int]]:
    found = []
    for m in runs:
        run = m.group()
        if any(c.isdigit() for c in run) and any(c.isalpha() for c in run) and likelihood_ratio(table, run) >= THRESHOLD:
            found.append((m.start(), 3, m.end()))
    return found


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_documents(docs: DataFrame, keep: list[str], threshold_table: np.ndarray | None = None) -> DataFrame:
    """row (a struct of the columns in keep), the counts of each kind, base_sha256 and spans. The models are made once, on the driver."""
    table = ratio_table(sampled_words(docs)) if threshold_table is None else threshold_table
    rows = docs.select(F.col("text").alias("text"), F.struct(*keep).alias("row"))
    added = (("n_assign", "long"), ("n_access", "long"), ("n_hex", "long"), ("n_random", "long"), ("base_sha256", "string"), ("spans", "string"))
    schema = rows.select("row").schema
    for name, kind in added:
        schema = schema.add(name, kind)

    def scan(batches):
        for batch in batches:
            out = []
            for value in batch.column(0):
                text = value.as_py() or ""
                runs = list(CANDIDATE.finditer(text))
                base = base_spans(text, runs)
                more = random_spans(runs, table)
                n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                out.append((*n, len(more), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + more))))
            columns = list(zip(*out, strict=True)) or [()] * 6
            arrays = [pa.array(c, pa.int64() if i < 4 else pa.string()) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([batch.column(1), *arrays], ["row", *(n for n, _ in added)])

    return rows.mapInArrow(scan, schema)


def redact_documents(docs: DataFrame, mark: str = "[secret]", threshold_table: np.ndarray | None = None) -> DataFrame:
    """docs with each span of the text (overlapping ones together) replaced by mark. n_chars follows the text if there is one."""
    table, columns = ratio_table(sampled_words(docs)) if threshold_table is None else threshold_table, docs.columns
    where = columns.index("text")
    count = columns.index("n_chars") if "n_chars" in columns else None

    def redact(batches):
        for batch in batches:
            texts, sizes = [], []
            for value in batch.column(where):
                text = value.as_py()
                runs = list(CANDIDATE.finditer(text or ""))
                spans = sorted(base_spans(text or "", runs) + random_spans(runs, table))
                if spans:
                    out, at = [], 0
                    for a, _, b in spans:
                        if a >= at:
                            out += [text[at:a], mark]
                        at = max(at, b)
                    text = "".join([*out, text[at:]])
                texts.append(text)
                sizes.append(None if text is None else len(text))
            arrays = list(batch.columns)
            arrays[where] = pa.array(texts, pa.string())
            if count is not None:
                arrays[count] = pa.array([n if t is not None else o for n, t, o in zip(sizes, texts, arrays[count].to_pylist(), strict=True)], arrays[count].type)
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return docs.mapInArrow(redact, docs.schema)
