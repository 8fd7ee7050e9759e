"""Every lake query against its SQL oracle."""

import pytest

from __spark_entry__ import entry
from lakebook.checks import CHECKS
from tests.support import compare


@pytest.mark.parametrize("name", list(CHECKS))
def test_matches_oracle(name, spark, duck, sf_dir):
    assert compare(CHECKS[name].run(spark, sf_dir), duck, CHECKS[name].sql) is None


def test_entry_is_the_whole_book(spark):
    book = entry(spark)
    assert len(book.columns) == 410
    assert 0 < book.count() <= 15
