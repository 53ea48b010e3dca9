"""Instants the tests share. Not in conftest.py: that name may stand for the file of another folder."""

import datetime as dt

T0 = dt.datetime(2024, 3, 1, 12, 0, 0)


def at(minutes=0, seconds=0, micros=0):
    return T0 + dt.timedelta(minutes=minutes, seconds=seconds, microseconds=micros)
