"""Customer usage scorecards as Spark DataFrames.

Every public function takes DataFrames (and, where time matters, an explicit
``as_of``) and returns DataFrames; nothing runs until a mart is written.
Instants are UTC: either epoch milliseconds or ``timestamp_ntz``, so no result
depends on the session time zone.
"""
