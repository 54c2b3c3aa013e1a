"""Tables stored in the shared folder live as long as their scope."""

from __future__ import annotations

from pathlib import Path

import pytest

from ontime.session import discard, handed_on, materialize, scope


def there(stored):
    return Path(stored.stored_path.removeprefix("file:")).exists()


def test_scope_deletes_what_was_stored_in_it(spark):
    outside = materialize(spark.range(3))
    with scope(spark):
        first = materialize(spark.range(5))
        with scope(spark):
            inner = materialize(spark.range(7))
            result = handed_on(inner.selectExpr("id + 1 AS id"))
            assert there(inner)
        assert not there(inner)
        assert result.count() == 7 and first.count() == 5
    assert not there(first) and not there(result)
    assert outside.count() == 3
    discard(outside)
    assert not there(outside)


def test_early_discard_and_failure(spark):
    with pytest.raises(ValueError), scope(spark):
        one, two = materialize(spark.range(1)), materialize(spark.range(2))
        discard(one)
        assert not there(one) and two.count() == 2
        raise ValueError
    assert not there(two)
    with scope(spark):
        kept = handed_on(spark.range(4))
    assert kept.count() == 4
    discard(kept)
