"""Operators that prepare text for language-model training.

Nothing outside this folder imports it; the entry file of the repository adds
its queries only where the folder exists.
"""
