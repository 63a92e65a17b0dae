import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from rampline.llm import quality

SCHEMA = "doc_id long, text string"
COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
PLAIN = "the cat sat on the mat and looked at all of the birds in that old tree near our house today"


def brute(doc, text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    repeat = len({i + k for i, w in enumerate(windows) if w in twice for k in range(5)})
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    n, chars, symbols = len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text)
    dup = len(lines) - len(set(lines))
    failed = n < 10 or 100 * repeat > 20 * n
    stops = sum(w.lower() in quality.STOP_WORDS for w in words)
    ok = bool(n) and 2 <= chars / n <= 14 and symbols / n <= 0.3 and (stops + 1) / n >= 0.02 and (not lines or dup / len(lines) <= 0.5)
    return doc, n, chars, symbols, dup, repeat, failed, not failed and ok


def check(spark, texts):
    rows = list(enumerate(texts))
    got = quality.measured(spark.createDataFrame(rows, SCHEMA)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == [brute(*row) for row in rows]


def test_measures(spark):
    check(
        spark,
        [
            None, "", " \n\t ", PLAIN, PLAIN, PLAIN + "\n" + PLAIN, "a b c d e " * 40, "# | $ " * 30 + PLAIN,
            "zzz " * 9, "one two three four five\n" * 4 + "six", " é ünï x " * 12,
            "xq " * 200, "\n\n" + "the line\n" * 50, "w" * 100_000, " ".join(f"w{i % 1000} the" for i in range(30_000)),
            " ".join(f"{chr(97 + i % 26)}{i} of" for i in range(300)), "x\x0by\x0cz\r\nq " * 5,
        ],
    )


@given(st.lists(st.text(alphabet="ab \n#the", max_size=120), min_size=30, max_size=30))
@settings(max_examples=4, deadline=None)
def test_random_texts(spark, texts):
    check(spark, texts)


def test_kept_rows_keep_their_columns(spark):
    docs = spark.createDataFrame([(1, PLAIN, 5, "v"), (2, "too short", 6, "v"), (None, PLAIN, None, None)], SCHEMA + ", n_words int, v string")
    assert sorted(quality.kept_only(docs).collect(), key=str) == sorted([(1, PLAIN, 5, "v"), (None, PLAIN, None, None)], key=str)


def test_other_rules(spark):
    rules = (quality.Rule("short", "mean_word_chars", None, 1.0),)
    rows = quality.measured(spark.createDataFrame([(1, PLAIN), (2, "a b c d e f g h i j")], SCHEMA), rules)
    assert sorted((r.doc_id, r.kept, r.broken) for r in rows.collect()) == [(1, False, ["short"]), (2, True, [])]


def test_empty_table(spark):
    assert quality.measured(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_projection_without_python(spark, capsys):
    quality.measured(spark.createDataFrame([(1, PLAIN)], SCHEMA)).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Arrow|Exchange", plan)
