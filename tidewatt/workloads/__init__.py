"""The operators applied to the given test tables, with SQL to check them against.

Two tables stand in for electricity readings: line items (ship date, line status
as the entity, price and discount as metrics) for the yearly and monthly queries,
and events (timestamp, event type, value and the number in ``props``) for the
hour-of-day queries.
"""
