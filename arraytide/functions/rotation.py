"""Frames: rotating pairs and 2 x 2 tensors, arm diagonals, mixed bases. Angles in degrees, R = [[c, s], [-s, c]]."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def rotate_pair(x: Column, y: Column, angle: Column) -> tuple[Column, Column]:
    a = F.radians(angle)
    return F.cos(a) * x + F.sin(a) * y, -F.sin(a) * x + F.cos(a) * y


def to_sensor(x: Column, y: Column, angle: Column) -> tuple[Column, Column]:
    """A mean-field pair turned back into the sensor frame."""
    return rotate_pair(x, y, -angle)


def mean_field_angle(x: str, y: str) -> Column:
    """Aggregate: the direction of the mean horizontal field over the jointly recorded samples."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    return F.degrees(F.atan2(F.avg(F.when(both, F.col(y))), F.avg(F.when(both, F.col(x)))))


def expected_gain(ln: Column, le: Column) -> Column:
    return F.when(le != 0, ln / le)


def diagonal_angle(ln: Column, le: Column) -> Column:
    return F.degrees(F.atan2(-le, ln))


def diagonal_length(ln: Column, le: Column) -> Column:
    return F.sqrt(ln * ln + le * le)


def diagonals(ex: Column, ey: Column, ln: Column, le: Column) -> tuple[Column, Column]:
    """The field along the arm diagonal, free of a shared centre, and along its orthogonal, which carries it."""
    d = diagonal_length(ln, le)
    return (ln * ex - le * ey) / d, (le * ex + ln * ey) / d


def matrix(angle: Column) -> list[list[Column]]:
    a = F.radians(angle)
    return [[F.cos(a), F.sin(a)], [-F.sin(a), F.cos(a)]]


def basis_correction(angle: Column, borrowed_x: Column, borrowed_y: Column) -> list[list[Column]]:
    """What a tensor's H basis is right-multiplied by where one or both channels were borrowed in the sensor frame."""
    r, inv = matrix(angle), matrix(-angle)
    eye = [[F.lit(1.0), F.lit(0.0)], [F.lit(0.0), F.lit(1.0)]]
    m = [[F.when(b, eye[i][j]).otherwise(r[i][j]) for j in (0, 1)] for i, b in enumerate((borrowed_x, borrowed_y))]
    return product(m, inv)


def product(a, b):
    return [[a[i][0] * b[0][j] + a[i][1] * b[1][j] for j in (0, 1)] for i in (0, 1)]


def transpose(a):
    return [[a[j][i] for j in (0, 1)] for i in (0, 1)]


def right(z, c):
    """Z C for a real C on the real or the imaginary parts."""
    return product(z, c)


def right_errors(e, c):
    """Errors combined in quadrature over the corrected columns."""
    return [[F.sqrt(F.pow(e[i][0] * c[0][j], 2) + F.pow(e[i][1] * c[1][j], 2)) for j in (0, 1)] for i in (0, 1)]


def turn_frame(z, angle: Column):
    """R Z R^T."""
    r = matrix(angle)
    return product(product(r, z), transpose(r))


def turn_columns(z, angle: Column):
    """Z R^T: the H columns alone."""
    return product(z, transpose(matrix(angle)))
