"""Tests of the optional subpackage; a package, so that its modules may have the names of others."""
