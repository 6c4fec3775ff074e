"""Operations of a training-data pipeline, each by the method its module names.

Nothing else in the library imports this subpackage.
"""
