"""Sources: landing files, microdata tables, dictionary files."""
