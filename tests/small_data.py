"""Where the tests' own tables lie."""

SF_SMALL = "/root/testdata/sf0.001"
