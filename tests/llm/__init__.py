"""Tests of the text operators; a package, so that its fixtures do not hide those above."""
