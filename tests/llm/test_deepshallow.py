from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from roadstream.llm.deepshallow import blind_trie, common_prefix, sort_strings

texts = st.lists(st.text("ab\0", max_size=80).map(str.encode), max_size=40)


def plain_prefix(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@settings(max_examples=150, deadline=None)
@given(texts, st.text("ab", max_size=50).map(str.encode))
def test_sorted_with_common_prefixes(strings, head):
    strings = strings + [head + s for s in strings]
    order, lcp = sort_strings(strings)
    assert sorted(order.tolist()) == list(range(len(strings)))
    assert [strings[i] for i in order] == sorted(strings)
    for k in range(1, len(strings)):
        assert lcp[k] == plain_prefix(strings[order[k - 1]], strings[order[k]])


def test_trie_of_equal_strings_and_prefixes():
    strings = [b"abc", b"ab", b"abc", b"", b"abd"]
    order, lcp = blind_trie(strings)
    assert [strings[i] for i in order] == sorted(strings)
    assert lcp == [0, 0, 2, 3, 2]


def test_common_prefix():
    assert common_prefix(b"", b"a") == 0
    assert common_prefix(b"abcd", b"abxd") == 2
    assert common_prefix(b"ab" * 100, b"ab" * 120) == 200
