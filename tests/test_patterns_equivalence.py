"""The linear request, page and host patterns accept exactly the strings the original
nested patterns accept (checked in Python's engine on random strings)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from hitscope.functions import patterns as P

# The original request and page patterns, as written in the
# original jobs (nested quantifiers), used here only as the reference.
ORIGINAL_REQUEST = r"^([A-Z])* (\/([a-zA-Z0-9\-\.\_\?\/\+\%\~\:]+)?)*(\.{1}([a-z0-9]+)*)?( [A-Z0-9]+\/[0-9|a-z|A-Z]+\.[0-9|a-z|A-Z])?$"
ORIGINAL_PAGE = r"^\/([a-z|A-Z]|\/|\-|[0-9]|\_)*.?(html|htm|\?|[0-9]*\,[0-9]*)?$"
ORIGINAL_NUMERIC_HOST = r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"
ORIGINAL_HOST_NAME = r"^([a-z]|[0-9]|\-|\_|\.)*\.([a-z])*$"

REQ_ALPHABET = "GETPOS /.-_?+%~:=,|aZz09HTP1"
PAGE_ALPHABET = "/ab|Z09-_.,?htmlx~"

_orig_req, _new_req = re.compile(ORIGINAL_REQUEST), re.compile(P.REQUEST_PATTERN)
_orig_page, _new_page = re.compile(ORIGINAL_PAGE), re.compile(P.PAGE_PATTERN)


@settings(max_examples=3000, deadline=None)
@given(st.text(alphabet=REQ_ALPHABET, max_size=24))
def test_request_pattern_equivalent(s):
    assert bool(_orig_req.search(s)) == bool(_new_req.search(s))


@settings(max_examples=3000, deadline=None)
@given(st.text(alphabet=REQ_ALPHABET, max_size=16).map(lambda t: "GET " + t))
def test_request_pattern_equivalent_with_method(s):
    assert bool(_orig_req.search(s)) == bool(_new_req.search(s))


@settings(max_examples=3000, deadline=None)
@given(st.text(alphabet=PAGE_ALPHABET, max_size=16).map(lambda t: "/" + t))
def test_page_pattern_equivalent(s):
    assert bool(_orig_page.search(s)) == bool(_new_page.search(s))


@settings(max_examples=3000, deadline=None)
@given(st.text(alphabet="az09.-_AZ,", max_size=16))
def test_host_patterns_equivalent(s):
    assert bool(re.search(ORIGINAL_HOST_NAME, s)) == bool(re.search(P.HOST_NAME_PATTERN, s))
    assert bool(re.search(ORIGINAL_NUMERIC_HOST, s)) == bool(re.search(P.NUMERIC_HOST_PATTERN, s))
