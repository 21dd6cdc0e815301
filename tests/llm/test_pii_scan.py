"""Found values against an independent scanner; domains of images; clashing names."""

import re
from bisect import bisect_right
from datetime import date

import pytest

from meshfold.llm import decontaminate, pii, quality
from meshfold.llm.common import table

SF = "/root/testdata/sf0.001"


def luhn_ok(s):
    digits, total = [int(x) for x in s if x.isdigit()], 0
    for i, x in enumerate(reversed(digits)):
        x = 2 * x if i % 2 else x
        total += x - 9 if x > 9 else x
    return 13 <= len(digits) <= 19 and total % 10 == 0


def iban_ok(s):
    s = re.sub(r"[ \xa0-]", "", s)
    return 15 <= len(s) <= 34 and int("".join(str(int(x, 36)) for x in s[4:] + s[:4])) % 97 == 1


def day_ok(s):
    a, b, c = (int(x) for x in re.findall(r"\d+", s))
    for y, m, d in ((a, b, c), (c, a, b), (c, b, a)):
        try:
            return 1900 <= date(y, m, d).year < 2100
        except ValueError:
            pass
    return False


SCAN = [(r"[\w.%+-]+@[\w.-]+\.[A-Za-z]{2,}", lambda s: True),
        (r"\b(?:\d{1,3}\.){3}\d{1,3}\b", lambda s: max(map(int, s.split("."))) < 256),
        (r"\b\d{3}-\d\d-\d{4}\b", lambda s: s[:3] not in ("000", "666") and s[:3] < "900" and s[4:6] > "00" and s[7:] > "0000"),
        (r"\b(?:\d[ \xa0-]?){12,18}\d\b", luhn_ok),
        (r"\b[A-Z]{2}\d\d(?:[ \xa0-]?[A-Z0-9]{4}){2,7}(?:[ \xa0-]?[A-Z0-9]{1,3})?\b", iban_ok),
        (r"\b\d{4}-\d\d-\d\d\b|\b\d\d[./]\d\d[./]\d{4}\b", day_ok),
        (r"\+\d[\d ().-]{6,}\d|\(\d{3}\) ?\d{3}-\d{4}|\b\d{3}-\d{3}-\d{4}\b", lambda s: True),
        (r"\b(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32})\b", lambda s: not s.isdigit() and not s.isalpha())]


def test_every_value_of_the_table_is_found_and_nothing_else(spark):
    rows = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    after = {r.doc_id: r.text for r in pii.pseudonymise(table(spark, SF, "documents"), b"k").collect()}
    values = 0
    for i, text in rows.items():
        old, new = re.split(r"\s", text or ""), re.split(r"\s", after[i] or "")
        assert len(old) == len(new)
        starts = [0]
        for word in old:
            starts.append(starts[-1] + len(word) + 1)
        changed = {k for k, (a, b) in enumerate(zip(old, new)) if a != b}
        seen = set()
        for pattern, valid in SCAN:
            for m in re.finditer(pattern, text or ""):
                if valid(m[0]):
                    words = set(range(bisect_right(starts, m.start()) - 1, bisect_right(starts, m.end() - 1)))
                    assert words & changed, m[0]
                    seen |= words
                    values += 1
        assert changed <= seen, [old[k] for k in changed - seen]
    assert values > 10


@pytest.mark.parametrize("before, value, after", [
    ("at ", "1985-03-12", "T10:00"), ("", "1985-03-12", "T10:00:05Z"), ("pay ", "4111\xa01111\xa01111\xa01111", " now"),
    ("", "GB82-WEST-1234-5698-7654-32", "."), ("", "GB82\xa0WEST\xa01234\xa05698\xa07654\xa032", " 500"),
    ("", "+1 (017)\xa0555-7713", "")])
def test_dates_of_time_stamps_and_other_gaps(before, value, after):
    c = pii.Cipher(b"key")
    new, n = pii.replace(before + value + after, c)
    assert n == 1 and new.startswith(before) and new.endswith(after) and value not in new
    assert [x.isalnum() for x in new] == [x.isalnum() for x in before + value + after]
    assert pii.replace(new, c, back=True) == (before + value + after, 1)


def test_images_stay_in_the_domain():
    """Preimages of texts that are no secrets (digits only, letters only) go on to one that is."""
    c = pii.Cipher(b"key")
    for image in ("32" * 16, "0" * 31 + "1", "ab" * 16, "f" * 32):
        before = "".join("0123456789abcdef"[d] for d in c.permute("secret", [int(x, 16) for x in image], [16] * 32, True))
        new, n = pii.replace(f"key {before} end", c)
        assert n == 1 and not new[4:36].isdigit() and not new[4:36].isalpha()
        assert pii.replace(new, c, back=True) == (f"key {before} end", 1)


@pytest.mark.parametrize("check", ["00", "01", "99"])
def test_check_digits_that_are_never_given_are_no_iban(check):
    for tail in range(400):
        text = f"DE{check}{tail:018d}"
        assert pii._iban(pii.Cipher(b"k"), text, False) is None


def test_results_take_the_place_of_columns_of_their_names(make):
    rows = make([(1, "call 017-555-7713 one two", "x", "y")], "doc_id bigint, text string, N_words string, score string")
    items = make([(1, "one two")], "item_id bigint, text string")
    marked = decontaminate.mark(rows, items, names=("n_words", "score", "found")).first()
    assert (marked.n_words, marked.score, marked.found) == (6, [4, 5], ["1"])
    assert pii.pseudonymise(rows, b"k", count="n_words").first().n_words == 1
    weights = quality.fit(quality.np.zeros((0, 1)), quality.np.zeros((0, 1)), 0.5)
    assert quality.score(rows, weights).first().score == 0.5
    with pytest.raises(ValueError):
        pii.pseudonymise(rows, b"k", count="Text")
