"""SQL forms of the feature query and the end-to-end dataset job."""
