"""Windows along flights, also for flights too long for one task."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from skyload.operators.ordering import exact_quantiles, join_on, split_by_length, with_row_index
from skyload.session import stable
from skyload.settings import Course

ROW, LENGTH, PIECE = "row_no", "n_points", "_piece"


@dataclass(frozen=True)
class FlightRows:
    """Points with their row number and flight length, ready for windows.

    Either every window partition is a whole flight, or (``in_pieces``) it is a row
    range of a long flight, with copies of the ``reach`` rows before and after
    it, so that a window that looks no further gives the same result.
    """

    frame: DataFrame
    course: Course
    in_pieces: bool
    piece_rows: int = 0

    @staticmethod
    def whole(points: DataFrame, course: Course) -> FlightRows:
        rows = FlightRows(points, course, in_pieces=False)
        return rows.with_columns({ROW: F.row_number().over(rows.along()).cast("long") - 1}).with_flight_values(
            {LENGTH: F.count(F.lit(1))}
        )

    @staticmethod
    def numbered(points: DataFrame, course: Course) -> DataFrame:
        """Row number and flight length of points of long flights."""
        return with_row_index(points, course.order, [course.key], ROW, LENGTH)

    @staticmethod
    def pieces(points: DataFrame, course: Course, reach: int) -> FlightRows:
        size = max(course.long_rows, reach)
        indexed = FlightRows.numbered(points, course)
        own = F.floor(F.col(ROW) / size)
        within = F.pmod(F.col(ROW), F.lit(size))
        copies = F.array_compact(
            F.array(
                own,
                F.when((within < reach) & (own > 0), own - 1),
                F.when(within >= size - reach, own + 1),
            )
        )
        cut = indexed.withColumn(PIECE, F.explode(copies))
        return FlightRows(cut, course, in_pieces=True, piece_rows=size)

    def along(self) -> WindowSpec:
        """The one window all neighbours are read through."""
        keys = [self.course.key, PIECE] if self.in_pieces else [self.course.key]
        return Window.partitionBy(*keys).orderBy(*self.course.order)

    def _own(self) -> DataFrame:
        if not self.in_pieces:
            return self.frame
        own = F.floor(F.col(ROW) / self.piece_rows)
        return self.frame.where(F.col(PIECE) == own).drop(PIECE)

    def result(self) -> DataFrame:
        """Each point once, without the working columns."""
        return self._own().drop(ROW, LENGTH)

    def with_columns(self, columns: dict[str, Column]) -> FlightRows:
        return replace(self, frame=self.frame.withColumns(columns))

    def mapped(self, change: Callable[[DataFrame], DataFrame]) -> FlightRows:
        """Apply a change that keeps rows as they are, such as a lookup."""
        return replace(self, frame=change(self.frame))

    def settled(self) -> FlightRows:
        """Before several passes over pieces: compute what they have so far once."""
        return replace(self, frame=stable(self.frame)) if self.in_pieces else self

    def with_flight_values(self, values: dict[str, Column]) -> FlightRows:
        """Add aggregates over the whole flight to each of its rows."""
        key = self.course.key
        if not self.in_pieces:
            # Over the same order as everything else, so that Spark joins the windows into one.
            flight = self.along().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            return self.with_columns({n: c.over(flight) for n, c in values.items()})
        per_flight = self._own().groupBy(key).agg(*[c.alias(n) for n, c in values.items()])
        return self.mapped(lambda frame: join_on(frame, per_flight, [key]))

    def with_flight_ends(self, first: str, last: str, value: Column, count: int) -> FlightRows:
        """Add the values of the flight's first and last ``count`` rows, as arrays, to each of its rows."""
        row, length = F.col(ROW), F.col(LENGTH)
        ends = {first: row < count, last: row >= length - count}
        if not self.in_pieces:
            return self.with_flight_values({n: F.collect_list(F.when(at, value)) for n, at in ends.items()})
        sorted_values = {
            n: F.transform(F.array_sort(F.collect_list(F.when(at, F.struct(row.alias("row"), value.alias("value"))))), lambda s: s["value"])
            for n, at in ends.items()
        }
        return self.with_flight_values(sorted_values)

    def with_flight_quantile(self, name: str, value: Column, probability: float) -> FlightRows:
        """Add an exact quantile of ``value`` over the whole flight to each of its rows."""
        key = self.course.key
        if not self.in_pieces:
            return self.with_flight_values({name: F.percentile(value, F.lit(probability))})
        values = self._own().select(key, value.alias("_value"))
        per_flight = exact_quantiles(values, "_value", {name: probability}, [key])
        return self.mapped(lambda frame: join_on(frame, per_flight, [key], "left"))

    def kept(self, condition: Column, reach: int) -> FlightRows:
        """Keep some rows; neighbours are then the kept ones."""
        if not self.in_pieces:
            return replace(self, frame=self.frame.where(condition))
        rest = self._own().where(condition).drop(ROW, LENGTH)
        return FlightRows.pieces(rest, self.course, reach)


def along_flights(
    points: DataFrame, course: Course, reach: int, step: Callable[[FlightRows], FlightRows]
) -> DataFrame:
    """Run ``step`` over all flights.

    Flights up to ``course.long_rows`` points share one exchange on the key; longer
    ones, if there are any, are cut into pieces.
    """
    course = course.over(points.columns)
    usual, long = split_by_length(points, course.key, course.long_rows)
    done = step(FlightRows.whole(usual, course)).result()
    if long is None:
        return done
    return done.unionByName(step(FlightRows.pieces(long, course, reach)).result())
