from hypothesis import given, settings
from hypothesis import strategies as st

from posegrain.operators.packed_fields import FieldTokenizer, split_packed

M = FieldTokenizer()


def test_tokenizer():
    v = lambda s: [x for x, _ in M.values(s)]
    assert v("[3, 4, 5]") == ["3", "4", "5"]
    assert v('"bay ""B"" 9"|"G; 9"|7') == ['bay "B" 9', "G; 9", "7"]
    assert v("'0'; '3'") == ["0", "3"]
    assert v(";;9;;9;") == ["9", "9"]
    assert v('"tag 13') == ["tag 13"]
    assert v('"a\\"b",c') == ['a"b', "c"]
    assert v("") == v("   ") == v(",,;") == v('""') == []
    assert list(M.values("[1, [2, (3)]]")) == [("1", 1), ("2", 2), ("3", 3)]
    assert v("0, 2/7|21 30\t4\n") == ["0", "2", "7", "21", "30", "4"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet='ab ",;|', min_size=1).filter(lambda s: s.strip(' ') == s and s != ""), max_size=8), st.sampled_from([",", ";", "|", ", "]))
def test_quoted_round_trip(values, sep):
    packed = sep.join('"' + v.replace('"', '""') + '"' for v in values)
    assert [v for v, _ in M.values(packed)] == values


def test_split(spark):
    rows = [(1, "3 4", 9), (1, "3 4", 9), (2, "a;'b c'", 8), (3, None, 7), (4, "", 6), (5, " ;, ", 5), (6, "7\n", 4), (7, "1 " * 5000 + "2", 3)]
    d = spark.createDataFrame(rows, "id long, f string, value_no int")
    got = split_packed(d, "id", "f").select("id", "value_no", "tag_value").collect()
    by = {}
    for r in got:
        by.setdefault(r.id, []).append((r.value_no, r.tag_value))
    assert sorted(by[1]) == [(1, "3"), (1, "3"), (2, "4"), (2, "4")]
    assert sorted(by[2]) == [(1, "a"), (2, "b c")]
    assert by[6] == [(1, "7")] and len(by[7]) == 5001 and set(by) == {1, 2, 6, 7}
    uneven = {r.id for r in split_packed(d, "id", "f", only_uneven=True).collect()}
    assert uneven == {2, 6}
    assert split_packed(d.limit(0), "id", "f").count() == 0


def test_another_escape():
    t = FieldTokenizer(escape="^")
    assert [v for v, _ in t.values('"a^"b" c')] == ['a"b', "c"]
    assert [v for v, _ in t.values('"a\\\\b"')] == ["a\\\\b"]
