"""Reports and cleaning steps as DataFrame operators.

The rule throughout: aggregate raw rows first, partially on the map side, and let only the small
aggregate meet a window, a quantile, a top-k or a join. A category that holds a third of all rows
is then one line of the aggregate and no task has to hold its rows.
"""
