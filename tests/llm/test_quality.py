from helpers import awkward, base_texts, prose, rows
from wayfarer.llm import quality_lines as Q

BLANK = set(" \t\n\x0b\x0c\r")


def slow_base(text):
    words, cur = [], ""
    for c in (text or "") + " ":
        if c in BLANK:
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if any(c not in BLANK for c in line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_base_columns_match_definition(spark):
    texts = base_texts() + ["a b c a b c", "x y x y x y x y", "l\nl\nl\n\n \n", "# | <a> & $5 *", prose(60, 8) + "\n" + prose(60, 8)]
    docs = awkward(spark, texts)
    for r in Q.quality_report(docs).collect():
        if r.doc_id is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == slow_base(
                texts[r.doc_id])
            assert not (r.kept and r.base_failed)


def test_line_rules():
    rules = Q.LineRules()
    assert Q.line_fault("Home | About | Contact | Login", 7, rules) == "navigation"
    assert Q.line_fault("Read more", 2, rules) == "navigation"
    assert Q.line_fault("word### other$$$ more***", 3, rules) == "punctuation"
    assert Q.line_fault("12 34 | 99 1 2 3", 7, rules)
    assert Q.line_fault("By using this site you accept our cookie policy.", 9, rules) == "boilerplate"
    assert Q.line_fault("A plain sentence with some words.", 6, rules) is None
    assert Q.line_fault("a long line without a mark at its end but with many words", 13, rules) is None


def test_clean_documents_removes_lines_and_rejects(spark):
    good, junk = prose(100, 4), " ".join(f"w{i}###" for i in range(120))
    texts = [good + "\nHome | About | Contact | Login\n" + prose(30, 6), junk, good + "\n" + junk, None, ""]
    out = Q.clean_documents(awkward(spark, texts))
    assert out.columns == awkward(spark, texts).columns
    assert {r.doc_id: r.text for r in out.collect()} == {0: good + "\n" + prose(30, 6)}


def test_empty_table_and_repeated_rows(spark):
    docs = awkward(spark, base_texts())
    assert Q.quality_report(docs.limit(0)).count() == 0
    once = rows(Q.quality_report(docs))
    assert rows(Q.quality_report(docs.unionByName(docs))) == sorted(once + once)
