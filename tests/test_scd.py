from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import day, rows
from millrace.operators import ChangeTable, current_rows, scd2_apply
from millrace.operators.scd import scd2_splice, scd2_splice_changes

SCHEMA = "book_id STRING, title STRING, price DOUBLE, current BOOLEAN, effective_date TIMESTAMP, end_date TIMESTAMP"
UPDATES = "book_id STRING, title STRING, price DOUBLE, updated TIMESTAMP"


def table(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def updates(spark, *data):
    return spark.createDataFrame(list(data), UPDATES)


def test_changed_same_and_new(spark):
    books = table(spark, ("a", "A", 1.0, True, day(1), None), ("b", "B", 2.0, True, day(1), None))
    new = updates(spark, ("a", "A", 9.0, day(2)), ("b", "B", 2.0, day(2)), ("c", "C", 3.0, day(2)))
    after = scd2_apply(books, new, "book_id", ["price"], "updated")
    assert rows(after) == sorted([
        ("a", "A", 1.0, False, day(1), day(2)), ("a", "A", 9.0, True, day(2), None),
        ("b", "B", 2.0, True, day(1), None), ("c", "C", 3.0, True, day(2), None),
    ], key=repr)
    assert rows(current_rows(after)) == [("a", "A", 9.0), ("b", "B", 2.0), ("c", "C", 3.0)]


def test_title_and_null_price_changes_are_ignored(spark):
    books = table(spark, ("a", "A", 1.0, True, day(1), None), ("b", "B", None, True, day(1), None))
    new = updates(spark, ("a", "Other", 1.0, day(2)), ("b", "B", 2.0, day(2)))
    assert rows(scd2_apply(books, new, "book_id", ["price"], "updated")) == rows(books)
    safe = scd2_apply(books, new, "book_id", ["price"], "updated", null_safe=True)
    assert safe.count() == 3 and safe.where("current").count() == 2


def test_two_changing_updates_for_one_book_are_chained(spark):
    books = table(spark, ("a", "A", 1.0, True, day(1), None))
    new = updates(spark, ("a", "A", 3.0, day(3)), ("a", "A", 2.0, day(2)), ("a", "A", None, day(4)))
    want = [("a", "A", 1.0, False, day(1), day(2)), ("a", "A", 2.0, False, day(2), day(3)), ("a", "A", 3.0, True, day(3), None)]
    assert rows(scd2_apply(books, new, "book_id", ["price"], "updated")) == sorted(want, key=repr)


def test_a_late_change_splits_the_interval_it_falls_in(spark):
    books = table(spark, ("a", "A", 1.0, False, day(1), day(5)), ("a", "A", 2.0, True, day(5), None), ("b", "B", 7.0, True, day(1), None))
    late = updates(spark, ("a", "A", 9.0, day(3)))
    want = [("a", "A", 1.0, False, day(1), day(3)), ("a", "A", 9.0, False, day(3), day(5)), ("a", "A", 2.0, True, day(5), None),
            ("b", "B", 7.0, True, day(1), None)]
    assert rows(scd2_splice(books, late, "book_id", ["price"], "updated")) == sorted(want, key=repr)


def brute_history(changes):
    """Versions of every key from all its changes, the last one of a moment given first."""
    out = []
    for key in {c[0] for c in changes}:
        moments = {}
        for _, title, price, at in [c for c in changes if c[0] == key]:
            moments[at] = (title, price)
        kept = []
        for at, (title, price) in sorted(moments.items(), key=lambda m: (m[0] is not None, m[0])):
            if not kept or kept[-1][1] != price:
                kept.append((title, price, at))
        for this, following in zip(kept, [*kept[1:], None]):
            out.append((key, *this[:2], following is None, this[2], following and following[2]))
    return sorted(out, key=repr)


change = st.tuples(st.sampled_from(["a", "b", None]), st.just("T"), st.sampled_from([1.0, 2.0, None]), st.sampled_from([None, *map(day, range(1, 9))]))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(change, max_size=6, unique_by=lambda c: (c[0], c[3])), min_size=1, max_size=3))
def test_history_does_not_depend_on_batches_or_order(spark, tmp_path_factory, batches):
    """Each batch is spliced in, into a frame and into a change table; both equal the history of all changes."""
    history = table(spark)
    kept = ChangeTable(spark, str(tmp_path_factory.mktemp("history")), SCHEMA, ["book_id", "effective_date"])
    for batch in batches:
        new = updates(spark, *batch)
        kept.commit(scd2_splice_changes(kept.current(), new, "book_id", ["price"], "updated"), "MERGE")
        history = scd2_splice(history, new, "book_id", ["price"], "updated")
    want = brute_spliced(batches)
    assert rows(history) == want
    assert rows(kept.current()) == want


def brute_spliced(batches):
    """Versions that a batch found equal to their forerunner are gone for later batches."""
    state = []
    for batch in batches:
        touched = {c[0] for c in batch}
        rest = [r for r in state if r[0] not in touched]
        state = rest + brute_history([(k, t, p, at) for k, t, p, _, at, _ in state if k in touched] + batch)
    return sorted(state, key=repr)


def test_repeated_unchanged_updates_do_nothing(spark):
    books = table(spark, ("a", "A", 1.0, True, day(1), None))
    new = updates(spark, *[("a", "A", 1.0, day(n)) for n in (2, 3, 4)])
    assert rows(scd2_apply(books, new, "book_id", ["price"], "updated")) == rows(books)


def test_a_price_that_returns_matches_only_the_open_row(spark):
    books = table(spark, ("a", "A", 1.0, False, day(1), day(2)), ("a", "A", 2.0, True, day(2), None))
    after = scd2_apply(books, updates(spark, ("a", "A", 1.0, day(3))), "book_id", ["price"], "updated")
    history = [(r.price, r.current, r.effective_date, r.end_date) for r in after.orderBy("effective_date").collect()]
    assert history == [
        (1.0, False, day(1), day(2)), (2.0, False, day(2), day(3)), (1.0, True, day(3), None),
    ]
    for before, later in zip(history, history[1:]):
        assert before[3] == later[2]
