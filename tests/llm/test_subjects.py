import datetime as dt
import random

from tapelake.llm import subjects

DOCS = "doc_id bigint, lang string, raw_body binary, http_status int, text string, terms string, labels string"
WORDS = {"sea": ["tide", "harbour", "boat", "anchor"], "sky": ["cloud", "wing", "pilot", "storm"], "rock": ["basalt", "quarry", "granite", "boat"], "oven": ["dough", "flour", "crust", "storm"],
    "choir": ["tenor", "hymn", "organ", "alto"], "loom": ["thread", "weft", "wool", "spindle"]}
USUAL = ["the", "was", "seen", "again", "and", "then", "left"]


def sentence(rnd, s):
    words = rnd.sample(USUAL, 4) + (rnd.sample(WORDS[s], 2) if s else [])
    rnd.shuffle(words)
    return " ".join(words).capitalize() + "."


def page(parts, tag="article"):
    menu = "<nav><p>tide tide. cloud.</p></nav><aside><li>granite quarry.</li></aside>"
    return f"<html><body>{menu}<{tag}>" + "".join(f"<p>{p}</p>" for p in parts) + f"</{tag}><footer>cloud wing. tide.</footer></body></html>"


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    rows, truth, labels = [], set(), []
    for k in range(n):
        picks = rnd.sample(sorted(WORDS), rnd.choice([1, 2])) if k % 10 else []
        plan = [p for p in picks for _ in range(4)] + [None] * rnd.choice([0, 1, 2, 8])
        plan = plan or [None, None]
        rnd.shuffle(plan)
        per = {p: plan.count(p) for p in picks}
        found = {(k, p) for p, c in per.items() if c * 4 >= len(plan)}
        body = page([" ".join(sentence(rnd, p) for p in plan[i : i + 3]) for i in range(0, len(plan), 3)])
        rows.append((k, rnd.choice(["en", "EN", "en-GB", None] * 5 + ["de"]), body.encode(rnd.choice(["utf-8", "utf-16"])), 200))
        truth |= found
        if k % 4 == 0:
            labels += [(k, p) for _, p in found] or [(k, None)]
    return rows, truth, labels


def frames(spark, rows, labels):
    d = spark.createDataFrame([(*r, "t", "x", "y") for r in rows], DOCS)
    s = spark.createDataFrame([(w, "note") for w in [*WORDS, None]], "subject string, scope_note string")
    return d, s, spark.createDataFrame([(*x, "desk") for x in labels], "doc_id bigint, subject string, labelled_by string")


def test_mixtures_find_the_subjects(spark):
    rows, truth, labels = corpus()
    labels = labels[:-3] + [(labels[0][0], "sky"), (None, "sea"), (5, "unknown")]
    got = [(r.doc_id, r.subject) for r in subjects.subject_shares(*frames(spark, rows, labels)).collect()]
    assert len(got) == len(set(got))
    right = len(set(got) & truth)
    assert right / len(got) > 0.97 and right / len(truth) > 0.97


def test_a_rare_wrong_mark_is_no_language(spark):
    rows, truth, labels = corpus(200)
    wrong = [(k, {7: "xx", 31: "zz"}.get(k, lang), body, status) for k, lang, body, status in rows]
    got = {(r.doc_id, r.subject) for r in subjects.subject_shares(*frames(spark, wrong, labels)).collect()}
    assert {x for x in got if x[0] in (7, 31)} == {x for x in truth if x[0] in (7, 31)} != set()
    articles = subjects.read_articles(frames(spark, wrong, labels)[0])
    assert subjects.vocabulary(articles).languages == 2


def test_more_labels_than_the_sample(spark, monkeypatch):
    rows, truth, labels = corpus(400, 3)
    monkeypatch.setattr(subjects, "MOST_LABELS", 60)
    got = {(r.doc_id, r.subject) for r in subjects.subject_shares(*frames(spark, rows, labels)).collect()}
    assert len({d for d, _ in labels}) > 90 and len(got & truth) / len(got | truth) > 0.95


def test_rare_words_stay_out_and_mixtures(spark):
    rows, truth, labels = corpus(200)
    words = subjects.vocabulary(subjects.read_articles(frames(spark, rows, labels)[0]), least_rate=0.3)
    assert 0 < len(words.keys) < len(subjects.vocabulary(subjects.read_articles(frames(spark, rows, labels)[0])).keys) and words.rates.min() >= 0.3
    shares = {}
    for r in subjects.mixtures(*frames(spark, rows, labels)).collect():
        shares.setdefault(r.doc_id, {})[r.subject] = r.share
    assert all(sum(x.values()) <= 1.000001 for x in shares.values())
    best = {(d, max(x, key=x.get)) for d, x in shares.items() if d in {k for k, _ in truth}}
    assert len(best & truth) / len(best) > 0.97


def test_pages_without_article(spark):
    rows, _, labels = corpus(120)
    body = page(["The tide was seen. The boat left the harbour."]).encode()
    odd = [(900, "en", None, 200), (901, "en", b"", 200), (902, None, b"\xff\xfe", 200), (903, "en", page([]).encode(), 200), (904, "en", body, 404), (905, "en", body, None), (906, "en",
        b"\x80\x81 no markup", 200), (907, "en", page(["The tide. " * 30000]).encode(), 200)]
    got = {r.doc_id for r in subjects.subject_shares(*frames(spark, rows + odd, labels)).collect()}
    assert got & set(range(900, 920)) == {905, 907}


def test_pages_without_text(spark):
    rows, _, labels = corpus(120)
    body = page(["The tide was seen. The boat left the harbour."]).encode()
    d, s, l = frames(spark, rows + [(k, "en", body, 200) for k in range(900, 904)], labels)  # noqa: E741
    texts = "case doc_id when 900 then null when 901 then '' when 902 then ' \\n' else text end as text"
    d = d.selectExpr("doc_id", "lang", "raw_body", "http_status", texts)
    assert {r.doc_id for r in subjects.read_articles(d).collect()} & {900, 901, 902, 903} == {903}
    assert {r.doc_id for r in subjects.subject_shares(d, s, l).collect()} & {900, 901, 902, 903} == {903}


def test_empty_tables(spark):
    rows, _, labels = corpus(30)
    d, s, l = frames(spark, rows, labels)  # noqa: E741
    assert subjects.subject_shares(d.limit(0), s, l).count() == 0
    assert subjects.subject_shares(d, s.limit(0), l).count() == 0
    assert subjects.subject_shares(d, s, l.limit(0)).count() == 0


def test_reading():
    assert subjects.article_sentences("<p>Zum 48. Mal. A &amp; B? <b>Yes</b>! On 1/2/2026. End</p><aside><p>No.</p></aside>") == ["Zum 48. Mal.", "A & B?", "Yes!", "On 1/2/2026.", "End"]
    assert subjects.decode("ä".encode("cp1252")) == subjects.decode("ä".encode()) == subjects.decode("ä".encode("utf-16")) == "ä"
    assert subjects.word_id("abc") == subjects.word_id("abc") != subjects.word_id("abd") and dt.MINYEAR == 1
