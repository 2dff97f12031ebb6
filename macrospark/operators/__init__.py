"""DataFrame-to-DataFrame operators.

``by`` is always the list of entity columns: empty for one national series,
or the keys of millions of entity series. Feature windows run at period
grain (one row per entity and period), so a window never holds more rows
than the calendar has periods, however many raw rows an entity has.
"""
