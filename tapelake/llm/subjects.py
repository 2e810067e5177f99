"""Subject areas of the articles of crawled pages, by seeded non-negative factorisation.

1. Pages are decoded by what their bytes are, not by what they declare, and reduced to the
   paragraphs of the article; its sentences become lists of hashed words.
2. Word rates by language, over all pages, correct missing and wrong language marks and give each
   language a fixed background component of words that most of its pages use.
3. The language of each page and its row of the document-term matrix are worked out once and
   written. The matrix is factored by alternating multiplicative updates (Kullback-Leibler).
   Components are anchored: one a subject, seeded from labelled pages, whose weights stay nearly
   confined to their labels, and one for pages that no subject applies to. Every update sums over
   all pages; each task sends one row a word, and the factor goes out as a broadcast variable.
4. The factor gives each page its mixture (`mixtures`) and each word its distribution over
   subjects. A sentence is about the component that is likeliest for its words under the page's
   mixture; sentences without subject words are about none. A page has the subjects of at least
   `SHARE` of its sentences.

What the driver and each task hold is the factor: the words that at least one page in
1 / `LEAST_RATE` of their language uses, which the length of pages bounds, not their number.

Labels enter as about `MOST_LABELS` labelled pages at most, those with the least hash of their id;
everything else covers all pages. Null or empty bodies, pages without paragraphs and pages with
an error status have no subject. Unknown subjects in labels are ignored, null ones mean none.
A language mark on fewer than `LEAST_PAGES` pages (of small corpora a fiftieth, three at least) is
no language; such pages are read in the one whose words they use. Rows of one doc_id are pages of
their own. Without labels nothing is found; a subject without labels in a language is not found in
it. Extra columns are ignored.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..session import materialize

SHARE = 0.25
#: Bound of the labelled sample the factorisation is seeded with.
MOST_LABELS = 20_000
#: Words on fewer of their language's pages are left out of the factor.
LEAST_RATE = 1 / 5000
#: Pages a language mark needs.
LEAST_PAGES = 20
WORD_BITS = 24
ROUNDS, INNER = 4, 4
#: Weight left to a labelled page's other subjects: some labels are wrong or missing.
SOFT = 0.1
#: Rates enter the background to this power, so that it holds what most pages use.
BACKGROUND_POWER = 2
#: A word is a subject word if its inverse Simpson index over the components is at most this part of the way from one component to all of them.
SPREAD = 1 / 3

_DROP = re.compile(r"<(nav|header|footer|aside|script|style|ul)\b.*?</\1\s*>", re.S | re.I)
_PARAGRAPH = re.compile(r"<p\b[^>]*>(.*?)</p\s*>", re.S | re.I)
_TAG = re.compile(r"<[^>]*>")
# A period after a bare short number is an ordinal.
_SENTENCE = re.compile(r"(?<=[.!?…。！？])(?<!\s\d\.)(?<!\s\d\d\.)(?<!\s\d\d\d\.)\s+")
_WORD = re.compile(r"[^\W\d_]+")


def decode(raw: bytes) -> str:
    """Text of a body by its own evidence: byte order mark, valid UTF-8, else Windows-1252."""
    if raw[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return raw.decode("utf-16", "replace")
    try:
        return raw.decode("utf-8-sig")
    except UnicodeDecodeError:
        return raw.decode("cp1252", "replace")


def article_sentences(page: str) -> list[str]:
    """Sentences of the article's paragraphs, without menus, notices, links and footers."""
    if "<p" not in page and "<P" not in page:
        return []
    out = []
    for p in _PARAGRAPH.findall(_DROP.sub(" ", page)):
        text = html.unescape(_TAG.sub("", p)).strip() if "<" in p or "&" in p else p.strip()
        if text:
            out += [s for s in _SENTENCE.split(text) if s]
    return out


def word_id(word: str) -> int:
    """A stable hash of a word (the same in every process)."""
    h = 2166136261
    for b in word.encode():
        h = ((h ^ b) * 16777619) & 0xFFFFFFFF
    return (h ^ (h >> 8)) & ((1 << WORD_BITS) - 1)


def _reader(batches):
    ids: dict[str, int] = {}
    for batch in batches:
        docs, langs, lengths, terms = [], [], [], []
        for d, lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            n, t = [], []
            for s in article_sentences(decode(raw)) if raw else ():
                words = _WORD.findall(s.lower())
                for w in words:
                    i = ids.get(w)
                    if i is None:
                        if len(ids) > 1_000_000:
                            ids.clear()
                        i = ids[w] = word_id(w)
                    t.append(i)
                n.append(len(words))
            if t:
                docs.append(d), langs.append(lang), lengths.append(n), terms.append(t)
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64()), pa.array(langs, pa.string()), pa.array(lengths, pa.list_(pa.int32())), pa.array(terms, pa.list_(pa.int32()))],
            ["doc_id", "lang", "lengths", "terms"],
        )


def read_articles(documents: DataFrame) -> DataFrame:
    """doc_id, lang as declared ('' if missing), words of each sentence (lengths, terms); pages without article words and null or blank texts are left out."""
    lang = F.coalesce(F.regexp_extract(F.lower("lang"), r"^\s*([a-z]{2,3})", 1), F.lit(""))
    usable = documents.where("raw_body is not null and (http_status is null or http_status < 400)").where(~is_blank(F.col("text")))
    return usable.select("doc_id", lang.alias("lang"), "raw_body").mapInArrow(_reader, "doc_id bigint, lang string, lengths array<int>, terms array<int>")


def _flat(batch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    col = batch.column(batch.schema.get_field_index(name))
    sizes = np.diff(col.offsets.to_numpy())
    return col.flatten().to_numpy(), np.repeat(np.arange(batch.num_rows), sizes)


def _batches(pdf_columns):
    names = [n for n, _ in pdf_columns]
    return lambda *arrays: pa.RecordBatch.from_arrays([pa.array(a, t) for a, (_, t) in zip(arrays, pdf_columns)], names)


def _rates(langs: list[str]):
    """Pages of each declared language and pages of each word in them: number of the language, term (-1: all pages), n."""
    make = _batches([("lang", pa.int32()), ("term", pa.int32()), ("n", pa.int64())])

    def run(batches):
        total: dict[int, int] = {}
        for batch in batches:
            where = {x: i for i, x in enumerate(langs)}
            lang = np.array([where.get(x, -1) for x in batch.column(0).to_pylist()], np.int64)
            terms, rows = _flat(batch, "terms")
            pairs = np.unique((rows.astype(np.int64) << WORD_BITS) | terms)
            row, term = pairs >> WORD_BITS, pairs & ((1 << WORD_BITS) - 1)
            keys = np.concatenate([(lang[row] << (WORD_BITS + 1)) | (term + 1), lang << (WORD_BITS + 1)])
            keys = keys[keys >= 0]
            for k, n in zip(*(x.tolist() for x in np.unique(keys, return_counts=True))):
                total[k] = total.get(k, 0) + n
        if total:
            k = np.fromiter(total, np.int64, len(total))
            yield make(k >> (WORD_BITS + 1), (k & ((1 << (WORD_BITS + 1)) - 1)) - 1, list(total.values()))

    return run


class Words:
    """The words of the factor: a row a (language, word), and how many of the language's pages use it."""

    def __init__(self, keys: np.ndarray, rates: np.ndarray, languages: int):
        self.keys, self.rates, self.languages = keys, rates, languages

    def rows(self, lang: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Row of each (language, word), -1 if unknown."""
        k = (lang.astype(np.int64) << WORD_BITS) | term
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[at] == k, at, -1)

    def detect(self, terms: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """Language of each page: the one whose pages use its words most."""
        score = np.zeros((n, self.languages))
        for lang in range(self.languages):
            at = self.rows(np.full(len(terms), lang), terms)
            rate = np.where(at >= 0, self.rates[at], 0.0)
            score[:, lang] = np.bincount(rows, np.log(rate + 1e-3), n)
        return score.argmax(1)

    @property
    def language(self) -> np.ndarray:
        return self.keys >> WORD_BITS


_MATRIX = [("doc_id", pa.int64()), ("labels", pa.int64()), ("at", pa.list_(pa.int32())), ("weight", pa.list_(pa.float32())), ("lengths", pa.list_(pa.int32())), ("words", pa.list_(pa.int32()))]
_MATRIX_SCHEMA = "doc_id bigint, labels bigint, at array<int>, weight array<float>, lengths array<int>, words array<int>"


def _lists(values: np.ndarray, owner: np.ndarray, n: int, kind) -> pa.Array:
    """List column of `values`, which are sorted by `owner`."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _labels_of(ids: np.ndarray, labelled: tuple[np.ndarray, np.ndarray]) -> pa.Array:
    """Label bits of pages, null where a page has none."""
    known, bits = labelled
    if not len(known):
        return pa.nulls(len(ids), pa.int64())
    at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
    return pa.array(bits[at], pa.int64(), mask=known[at] != ids)


def _matrix(words, labelled):
    """Each page in its language: rows and weights of the document-term matrix, and the row of every word of every sentence (-1 if unknown)."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            known: Words = words.value
            terms, rows = _flat(batch, "terms")
            distinct, counts = np.unique((rows.astype(np.int64) << WORD_BITS) | terms, return_counts=True)
            page, term = distinct >> WORD_BITS, distinct & ((1 << WORD_BITS) - 1)
            lang = known.detect(term, page, n)
            at = known.rows(lang[page], term)
            use = at >= 0
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            arrays = [column("doc_id"), _labels_of(column("doc_id").to_numpy(), labelled.value), _lists(at[use], page[use], n, pa.int32()), _lists(np.sqrt(counts[use]).astype(np.float32),
                page[use], n, pa.float32()), column("lengths"), _lists(known.rows(lang[rows], terms), rows, n, pa.int32())]
            yield pa.RecordBatch.from_arrays([a.cast(t) for a, (_, t) in zip(arrays, _MATRIX)], [name for name, _ in _MATRIX])

    return run


def _masks(labels: list, k: int) -> tuple[np.ndarray, np.ndarray]:
    """How far each component may be used by each page, and which pages are labelled. labels: bits of the subjects of a page, 0 for none, null if unlabelled."""
    mask = np.ones((len(labels), k + 1))
    labelled = np.array([x is not None for x in labels], bool)
    for i in np.flatnonzero(labelled):
        mask[i, :k] = SOFT
        mask[i, [j for j in range(k - 1) if labels[i] >> j & 1] or [k - 1]] = 1
    return mask, labelled


def _mixtures(weights: np.ndarray, page, at, weight, mask, inner: int = INNER) -> np.ndarray:
    """Mixture of every page for fixed components."""
    n = len(mask)
    mix = mask / mask.sum(1, keepdims=True)
    h = weights[at]
    for _ in range(inner):
        q = weight / (np.einsum("ij,ij->i", mix[page], h) + 1e-12)
        gain = np.stack([np.bincount(page, q * h[:, j], n) for j in range(h.shape[1])], 1)
        mix = mix * gain * mask
        mix /= mix.sum(1, keepdims=True) + 1e-12
    return mix


def _cells(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(page, row, weight) of the matrix of a batch."""
    at, page = _flat(batch, "at")
    return page, at, _flat(batch, "weight")[0].astype(float)


def _summed(shape: tuple[int, int], factor):
    """Numerators of the component update, or without a factor the seed, summed over the pages of a task: one row a word."""
    size, k = shape
    make = _batches([("row", pa.int64()), *[(f"c{j}", pa.float64()) for j in range(k)]])

    def run(batches):
        total = np.zeros((size, k))
        for batch in batches:
            if not batch.num_rows:
                continue
            page, at, weight = _cells(batch)
            mask, labelled = _masks(batch.column(batch.schema.get_field_index("labels")).to_pylist(), k)
            if factor is None:
                part = (mask[:, :k] == 1) * labelled[:, None]
                part = part / np.maximum(part.sum(1, keepdims=True), 1)
                share = weight[:, None] * part[page]
            else:
                weights = factor.value
                mix = _mixtures(weights, page, at, weight, mask)
                q = weight / (np.einsum("ij,ij->i", mix[page], weights[at]) + 1e-12)
                share = q[:, None] * mix[page][:, :k]
            for j in range(k):
                total[:, j] += np.bincount(at, share[:, j], size)
        used = np.flatnonzero(total.any(1))
        yield make(used, *[total[used, j] for j in range(k)])

    return run


def _gather(matrix: DataFrame, shape: tuple[int, int], weights: np.ndarray | None) -> np.ndarray:
    """The sums of `_summed` over all pages: the factor's size, whatever the number of pages."""
    size, k = shape
    factor = None if weights is None else matrix.sparkSession.sparkContext.broadcast(weights)
    schema = "row bigint, " + ", ".join(f"c{j} double" for j in range(k))
    parts = matrix.select("labels", "at", "weight").mapInArrow(_summed(shape, factor), schema).groupBy("row").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(k)]).toPandas()
    if factor is not None:
        factor.destroy()
    out = np.zeros(shape)
    out[parts["row"].to_numpy()] = parts[[f"c{j}" for j in range(k)]].to_numpy()
    return out


def vocabulary(articles: DataFrame, least_rate: float = LEAST_RATE, least_pages: int = LEAST_PAGES) -> Words | None:
    """The words of every language that has enough pages, used by enough of them."""
    marked = {r["lang"]: r["count"] for r in articles.where("lang <> ''").groupBy("lang").count().collect()}  # marks of two or three letters
    least = min(least_pages, max(3, sum(marked.values()) // 50))
    langs = sorted(x for x, n in marked.items() if n >= least) or sorted(marked)
    if not langs:
        return None
    seen = articles.select("lang", "terms").mapInArrow(_rates(langs), "lang int, term int, n bigint").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    # Every word's language and its pages: a row a language is enough to leave out rare words before anything reaches the driver.
    pages = np.array([marked[x] for x in langs], float)
    bound = F.array(*[F.lit(float(n * least_rate)) for n in pages])
    kept = seen.where("term >= 0").where(F.col("n") >= F.get(bound, F.col("lang"))).toPandas()
    keys = (kept.lang.to_numpy().astype(np.int64) << WORD_BITS) | kept.term.to_numpy()
    order = np.argsort(keys)
    return Words(keys[order], (kept.n.to_numpy() / pages[kept.lang.to_numpy()])[order], len(langs))


def _normalise(weights: np.ndarray, language: np.ndarray, languages: int) -> None:
    for x in range(languages):
        weights[language == x] /= weights[language == x].sum(0) + 1e-12


def fit(matrix: DataFrame, words: Words, subjects: int, rounds: int = ROUNDS) -> np.ndarray:
    """The factor: weights of each word's row in each component (subjects, none, background), from all pages of the matrix."""
    k, lang = subjects + 1, words.language
    shape = (len(words.keys), k)
    seeds = _gather(matrix.where("labels is not null"), shape, None)
    weights = np.zeros((len(words.keys), k + 1))
    weights[:, :k] = seeds
    weights[:, k] = words.rates**BACKGROUND_POWER
    weights += 1e-6
    _normalise(weights, lang, words.languages)
    usual = words.rates[:, None] / np.bincount(lang, words.rates, words.languages)[lang][:, None]
    weights[:, :k] = np.maximum(weights[:, :k] - 0.5 * usual, 1e-6)
    # A subject without labels in a language has no anchor there and stays off.
    anchored = np.stack([np.bincount(lang, seeds[:, j], words.languages) > 0 for j in range(k)], 1)[lang]
    weights[:, :k] *= anchored
    _normalise(weights, lang, words.languages)
    for _ in range(rounds):
        weights[:, :k] = (weights[:, :k] * _gather(matrix, shape, weights) + 1e-9) * anchored
        _normalise(weights, lang, words.languages)
    return weights


def _decide(factor, subjects: list[str], share: float):
    """Subjects of pages by the sentences that are about them."""
    k = len(subjects) + 1
    make = _batches([("doc_id", pa.int64()), ("subject", pa.string()), ("sentences", pa.int32()), ("of", pa.int32())])

    def run(batches):
        weights = factor.value
        own = weights[:, :k]
        p = own / (own.sum(1, keepdims=True) + 1e-12)
        is_subject_word = 1 / np.maximum((p * p).sum(1), 1e-12) <= 1 + SPREAD * (k - 1)
        evidence = np.where(is_subject_word[:, None], np.log((p + 0.05) / (1 / k + 0.05)), 0.0)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            page, at, weight = _cells(batch)
            mix = _mixtures(weights, page, at, weight, _masks(batch.column(batch.schema.get_field_index("labels")).to_pylist(), k)[0])
            row = _flat(batch, "words")[0]
            lengths, owner = _flat(batch, "lengths")
            sentence = np.repeat(np.arange(len(lengths)), lengths)
            use = (row >= 0) & is_subject_word[row]
            score = np.stack([np.bincount(sentence[use], evidence[row[use], j], len(lengths)) for j in range(k)], 1)
            about = np.bincount(sentence[use], minlength=len(lengths)) > 0
            best = (score + np.log(mix[owner][:, :k] + 0.02)).argmax(1)
            per = np.zeros((n, k), int)
            np.add.at(per, (owner[about], best[about]), 1)
            total = np.bincount(owner, minlength=n)
            doc, subject = np.nonzero((per[:, : k - 1] >= share * total[:, None]) & (per[:, : k - 1] > 0))
            ids = batch.column(0).to_numpy()
            yield make(ids[doc], [subjects[j] for j in subject], per[doc, subject], total[doc])

    return run


def _shares(factor, subjects: list[str]):
    """The mixture of every page over subjects and none, without the background."""
    k = len(subjects) + 1
    make = _batches([("doc_id", pa.int64()), ("subject", pa.string()), ("share", pa.float64())])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                page, at, weight = _cells(batch)
                mix = _mixtures(factor.value, page, at, weight, _masks(batch.column(batch.schema.get_field_index("labels")).to_pylist(), k)[0])[:, :k]
                mix = mix / (mix.sum(1, keepdims=True) + 1e-12)
                doc, subject = np.nonzero(mix[:, : k - 1] > 0.005)
                yield make(batch.column(0).to_numpy()[doc], [subjects[j] for j in subject], mix[doc, subject])

    return run


def _fitted(documents: DataFrame, subjects: DataFrame, labels: DataFrame, rounds: int):
    """(matrix, broadcast factor, names of the subjects), or None if there is nothing to learn from."""
    names = sorted(r["subject"] for r in subjects.where("subject is not null").select("subject").distinct().collect())  # a fixed list
    if len(names) > 62:
        raise ValueError("at most 62 subjects")
    bit = F.create_map(*[x for i, s in enumerate(names) for x in (F.lit(s), F.lit(1 << i))]) if names else None
    bits = F.lit(0).cast("bigint") if bit is None else F.coalesce(bit[F.col("subject")], F.lit(0)).cast("bigint")
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.bit_or(bits).alias("labels"))
    # A threshold on the hash instead of a sort: no task or driver holds more than the sample.
    pages = known.count()
    if pages > MOST_LABELS:
        known = known.where(F.xxhash64("doc_id").bitwiseAND((1 << 53) - 1) < int((1 << 53) * (MOST_LABELS / pages)))
    sample = known.toPandas().sort_values("doc_id")  # two numbers a labelled page, about MOST_LABELS of them
    articles = materialize(read_articles(documents.select("doc_id", "lang", "raw_body", "http_status", "text")))
    words = vocabulary(articles)
    if words is None or not len(words.keys):
        return None
    context = documents.sparkSession.sparkContext
    labelled = context.broadcast((sample["doc_id"].to_numpy(np.int64), sample["labels"].to_numpy(np.int64)))
    matrix = materialize(articles.select("doc_id", "lengths", "terms").mapInArrow(_matrix(context.broadcast(words), labelled), _MATRIX_SCHEMA))
    return matrix, context.broadcast(fit(matrix, words, len(names), rounds)), names


def subject_shares(documents: DataFrame, subjects: DataFrame, labels: DataFrame, share: float = SHARE, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, subject, sentences, of: every subject that at least `share` of the sentences of a page's article are about."""
    schema = "doc_id bigint, subject string, sentences int, of int"
    got = _fitted(documents, subjects, labels, rounds)
    if got is None:
        return documents.sparkSession.createDataFrame([], schema)
    matrix, factor, names = got
    return matrix.mapInArrow(_decide(factor, names, share), schema)


def mixtures(documents: DataFrame, subjects: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, subject, share: what part of a page's words the factor gives to each subject, words of the background aside; shares up to 0.005 are left out."""
    schema = "doc_id bigint, subject string, share double"
    got = _fitted(documents, subjects, labels, rounds)
    if got is None:
        return documents.sparkSession.createDataFrame([], schema)
    matrix, factor, names = got
    return matrix.mapInArrow(_shares(factor, names), schema)


def composition(found: DataFrame) -> DataFrame:
    """subject, pages, sentences: the make-up of the corpus."""
    return found.groupBy("subject").agg(F.count("*").alias("pages"), F.sum("sentences").alias("sentences"))
