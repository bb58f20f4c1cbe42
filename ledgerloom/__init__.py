"""Membership onboarding, sales and image-event analytics as Spark DataFrame functions.

Sub-packages:

* ``functions``  Column builders (names, birthdays, contact fields, ids).
* ``operators``  DataFrame -> DataFrame operators (verdicts, profiles, sales, integrity, events).
* ``sources``    CSV batches, typed loads, run outputs.
* ``streaming``  Structured Streaming jobs over the same operators.
* ``plans``      registered queries with their DuckDB counterparts.
"""
