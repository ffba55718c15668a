"""Layouts: how published headers map onto canonical, typed columns.

The texts in this package are fixed values of the published data.
"""
